"""Silver -> gold: the OMOP PERSON, CONDITION_OCCURRENCE and MEASUREMENT tables.

Each transform is one projection without a shuffle (with a large vocabulary: one
broadcast join), so the same function serves a batch of any size and a streaming frame.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake import fixed_values as fixed
from clinlake.functions.keys import surrogate_key
from clinlake.functions.lookup import with_concept
from clinlake.functions.parsing import (
    date_parts,
    info_value,
    joined_source_value,
    normalise,
    number_or_zero,
    safe_number,
    safe_timestamp,
)
from clinlake.operators.columns import first_present, present_name, project, union_by_name

# A dictionary of codes, a vocabulary table of one category, or the built-in codes.
Mapped = Mapping[str, int] | DataFrame | None


def _mapping(given: Mapped, category: str) -> Mapping[str, int] | DataFrame:
    return fixed.CONCEPTS[category] if given is None else given


def person(
    patients: DataFrame,
    genders: Mapped = None,
    races: Mapped = None,
    ethnicities: Mapped = None,
    key_style: str = "masked",
) -> DataFrame:
    """PERSON from silver patients (needs ``parsed_birth_dt``)."""
    year, month, day = date_parts("parsed_birth_dt")
    demographics = {
        "gender": _mapping(genders, "gender_to_concept"),
        "race": _mapping(races, "race_to_concept"),
        "ethnicity": _mapping(ethnicities, "ethnicity_to_concept"),
    }
    values = {
        "person_id": surrogate_key("raw_patient_id", style=key_style),
        "person_source_value": F.col("raw_patient_id"),
        "birth_datetime": F.col("parsed_birth_dt"),
        "year_of_birth": year,
        "month_of_birth": month,
        "day_of_birth": day,
    }
    coded = patients
    for name, mapping in demographics.items():
        coded = with_concept(coded, f"_{name}", name, mapping)
        values[f"{name}_concept_id"] = F.col(f"_{name}")
        values[f"{name}_source_value"] = F.col(name)
    return project(coded, values, fixed.GOLD_LAYOUT["person"], keep_type={"birth_datetime"})


def condition_occurrence(
    diagnoses: DataFrame, codes: Mapped = None, key_style: str = "masked"
) -> DataFrame:
    """CONDITION_OCCURRENCE from silver diagnoses (needs ``parsed_diag_dt``).

    The key covers encounter, code and date, so that several diagnoses of one
    encounter stay apart. What the source does not record stays NULL.
    """
    coded = with_concept(
        diagnoses, "_concept_id", "icd10_code", _mapping(codes, "icd10_to_snomed"), form="dotless"
    )
    values = {
        "condition_occurrence_id": surrogate_key(
            "encounter_id", normalise("icd10_code"), "parsed_diag_dt", style=key_style
        ),
        "person_id": surrogate_key("raw_patient_id", style=key_style),
        "condition_concept_id": F.col("_concept_id"),
        "condition_start_date": F.col("parsed_diag_dt"),
        "condition_type_concept_id": fixed.CONDITION_TYPE_EHR,
        "condition_source_value": joined_source_value("icd10_code", "diagnosis_description"),
        "condition_source_concept_id": fixed.NO_CONCEPT,
    }
    return project(coded, values, fixed.GOLD_LAYOUT["condition_occurrence"])


def measurement_from_labs(
    labs: DataFrame, codes: Mapped = None, key_style: str = "masked"
) -> DataFrame:
    """MEASUREMENT from lab results.

    Date and time come from the parsed silver columns where they exist, and are
    parsed from ``lab_datetime`` where they do not.
    """
    if present_name(labs, "parsed_lab_datetime"):
        taken_at = F.col("parsed_lab_datetime")
    elif present_name(labs, "lab_datetime"):
        taken_at = safe_timestamp("lab_datetime")
    else:
        taken_at = F.lit(None).cast("timestamp")
    taken_on = F.col("parsed_lab_dt") if present_name(labs, "parsed_lab_dt") else taken_at
    coded = with_concept(labs, "_concept_id", "loinc_code", _mapping(codes, "loinc_to_concept"))
    values = {
        "measurement_id": surrogate_key("lab_event_id", style=key_style),
        "person_id": surrogate_key("raw_patient_id", style=key_style),
        "measurement_concept_id": F.col("_concept_id"),
        "measurement_date": taken_on.cast("date"),
        "measurement_datetime": taken_at,
        "measurement_type_concept_id": fixed.MEASUREMENT_TYPE_LAB,
        "value_as_number": safe_number(F.col("numeric_value").cast("string")),
        "value_as_concept_id": fixed.NO_CONCEPT,
        "unit_source_value": F.col("unit_value"),
        "measurement_source_value": joined_source_value("loinc_code", "test_name"),
        "value_source_value": F.col("numeric_value"),
    }
    return project(coded, values, fixed.GOLD_LAYOUT["measurement"])


def measurement_from_variants(
    variants: DataFrame,
    significances: Mapped = None,
    key_style: str = "masked",
    default_patient: str | None = None,
    default_sample: str | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """MEASUREMENT from VCF rows: one variant call is one measurement.

    Without a patient (sample) column the rows stay unassigned, unless the caller
    names the one patient (sample) that the file is about.
    """
    patient = first_present(variants, "patient_id", "patient", absent=default_patient)
    sample = first_present(variants, "sample_id", "sample", absent=default_sample)
    gene, significance = info_value("info", "GENE"), info_value("info", "CLNSIG")
    locus = [F.col(c) for c in ("chrom", "pos", "ref", "alt", "id")]
    coded = with_concept(
        variants,
        "_concept_id",
        significance,
        _mapping(significances, "clinvar_to_concept"),
        form="normalised" if ignore_case else "exact",
    )
    values = {
        "measurement_id": surrogate_key(patient, sample, *locus, style=key_style),
        "person_id": surrogate_key(patient, style=key_style),
        "measurement_concept_id": fixed.VARIANT_MEASUREMENT_CONCEPT,
        "measurement_type_concept_id": fixed.MEASUREMENT_TYPE_VARIANT,
        "value_as_number": number_or_zero("qual"),
        "value_as_concept_id": F.col("_concept_id"),
        "unit_source_value": fixed.VARIANT_UNIT,
        "measurement_source_value": joined_source_value(sample, "filter"),
        "value_source_value": joined_source_value(*locus, gene, significance),
    }
    return project(coded, values, fixed.GOLD_LAYOUT["measurement"])


def measurement(labs: DataFrame, variants: DataFrame, key_style: str = "masked") -> DataFrame:
    """MEASUREMENT of both sources; rows are kept as they are, duplicates included."""
    return union_by_name(
        measurement_from_labs(labs, key_style=key_style),
        measurement_from_variants(variants, key_style=key_style),
    )
