"""Silver split and the OMOP transforms."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clinlake.operators import columns, omop, registry, silver
from tests.conftest import TESTDATA, rows


def people(spark, *genders):
    data = [(f"PAT_{i}", g, "WHITE", "HISPANIC", date(1988, 11, 23)) for i, g in enumerate(genders)]
    return spark.createDataFrame(
        data, "raw_patient_id string, gender string, race string, ethnicity string, parsed_birth_dt date"
    )


def test_person_genders(spark):
    df = omop.person(people(spark, "MALE", "m", "FEMALE", "F", "UNKNOWN", None))
    got = [r["gender_concept_id"] for r in df.orderBy("person_source_value").collect()]
    assert got == [8507, 8507, 8532, 8532, 0, 0]


def test_person_race_ethnicity_and_dates(spark):
    df = spark.createDataFrame(
        [("A", "M", r, e, datetime(1988, 11, 23, 8, 30)) for r, e in
         (("WHITE", "HISPANIC"), ("ASIAN", "NOT_HISPANIC"), ("BLACK", "NON_HISPANIC"), ("OTHER", "UNKNOWN"))],
        "raw_patient_id string, gender string, race string, ethnicity string, parsed_birth_dt timestamp",
    )
    got = omop.person(df).collect()
    assert [r["race_concept_id"] for r in got] == [8527, 8515, 8516, 0]
    assert [r["ethnicity_concept_id"] for r in got] == [38003563, 38003564, 38003564, 0]
    assert {(r["year_of_birth"], r["month_of_birth"], r["day_of_birth"]) for r in got} == {(1988, 11, 23)}


def test_person_keeps_sources_and_birth_type(spark):
    row = omop.person(people(spark, " m ")).first()
    assert row["person_id"] > 0 and row["gender_source_value"] == " m " and row["birth_datetime"] == date(1988, 11, 23)
    assert [f.name for f in omop.person(people(spark, "M")).schema.fields] == list(
        omop.fixed.GOLD_LAYOUT["person"]
    )


def test_custom_mappings_are_normalised_on_both_sides(spark):
    df = people(spark, "Divers")
    assert omop.person(df, genders={" divers ": 5, "_note": 1}).first()["gender_concept_id"] == 5


def test_null_ids_do_not_share_a_person(spark):
    df = people(spark, "M").withColumn("raw_patient_id", F.lit(None).cast("string"))
    assert omop.person(df).first()["person_id"] is None


def diagnoses(spark, *codes, encounter="ENC_1"):
    data = [(encounter, "PAT_1", c, "Primary Hypertension", date(2023, 3, 15)) for c in codes]
    return spark.createDataFrame(
        data,
        "encounter_id string, raw_patient_id string, icd10_code string, diagnosis_description string, "
        "parsed_diag_dt date",
    )


def test_conditions(spark):
    codes = ["E11.9", "I10", "J45.909", "I21.9", "C34.90", "Z00.00"]
    got = {r["condition_source_value"].split(":")[0]: r for r in omop.condition_occurrence(diagnoses(spark, *codes)).collect()}
    assert [got[c]["condition_concept_id"] for c in codes] == [201826, 316866, 195080, 4329847, 254637, 0]
    row = got["I10"]
    assert row["condition_source_value"] == "I10:Primary Hypertension" and row["condition_type_concept_id"] == 32817
    assert row["condition_start_date"] == date(2023, 3, 15)
    absent = (
        "condition_start_datetime", "condition_end_date", "condition_end_datetime", "stop_reason", "provider_id",
        "visit_occurrence_id",
    )
    assert all(row[c] is None for c in absent)
    assert len({r["condition_occurrence_id"] for r in got.values()}) == 6
    assert len({r["person_id"] for r in got.values()}) == 1


def labs(spark, extra, *data):
    return spark.createDataFrame(
        list(data),
        "lab_event_id string, raw_patient_id string, loinc_code string, test_name string, "
        f"numeric_value string, unit_value string, {extra}",
    )


def test_labs(spark):
    codes = ["4548-4", "2345-7", "2093-3", "2160-0", "33959-8", "9999-9"]
    df = labs(spark, "parsed_lab_dt date", *[(f"L{i}", "P", c, "t", "7.8", "%", date(2023, 3, 15)) for i, c in enumerate(codes)])
    got = omop.measurement_from_labs(df).collect()
    by_code = {r["measurement_source_value"].split(":")[0]: r for r in got}
    assert [by_code[c]["measurement_concept_id"] for c in codes] == [3004410, 3000483, 3004249, 3016723, 3006923, 0]
    row = by_code["4548-4"]
    assert (row["value_as_number"], row["unit_source_value"], row["measurement_type_concept_id"]) == (7.8, "%", 45754907)
    assert row["measurement_date"] == date(2023, 3, 15) and row["measurement_datetime"] is None


def test_labs_from_text_times_and_qualitative_values(spark):
    df = labs(
        spark, "lab_datetime string",
        ("L1", "P", "4548-4", "t", "Positive", "%", "2023-03-15 11:30:00"),
        ("L2", "P", "4548-4", "t", "1", "%", "n/a"),
    )
    first, second = omop.measurement_from_labs(df).orderBy("value_source_value").collect()[::-1]
    assert first["measurement_datetime"] == datetime(2023, 3, 15, 11, 30) and first["measurement_date"] == date(2023, 3, 15)
    assert first["value_as_number"] is None and first["value_source_value"] == "Positive"
    assert second["measurement_date"] is None and second["value_as_number"] == 1.0


def test_labs_without_any_time(spark):
    row = omop.measurement_from_labs(labs(spark, "flag string", ("L", "P", "x", "t", "1", "u", "f"))).first()
    assert row["measurement_date"] is None and row["measurement_datetime"] is None


def variants(spark, *data, names="patient_id string, sample_id string"):
    return spark.createDataFrame(
        list(data),
        f"chrom string, pos bigint, ref string, alt string, id string, qual string, filter string, info string, {names}",
    )


def test_variants(spark):
    signs = ["Pathogenic", "Likely_pathogenic", "Benign", "Likely_benign", "Uncertain_significance", "Not_provided"]
    df = variants(spark, *[("chr1", i, "A", "T", f"rs{i}", "99.5" if i else ".", "PASS", f"GENE=G;CLNSIG={s}", "P", "S") for i, s in enumerate(signs)])
    got = omop.measurement_from_variants(df).orderBy("value_source_value").collect()
    assert [r["value_as_concept_id"] for r in got] == [4181412, 36768280, 4049393, 36768279, 4078249, 0]
    assert [r["value_as_number"] for r in got] == [0.0] + [99.5] * 5
    assert {(r["measurement_concept_id"], r["measurement_type_concept_id"], r["unit_source_value"]) for r in got} == {(35917873, 4182210, "VCF_QUAL")}
    assert got[0]["value_source_value"] == "chr1:0:A:T:rs0:G:Pathogenic" and got[0]["measurement_source_value"] == "S:PASS"
    assert all(r["measurement_date"] is None and r["measurement_datetime"] is None for r in got)


def test_variant_patient_columns(spark):
    row = ("chr1", 1, "A", "T", "rs", "1", "PASS", "CLNSIG=benign", "P9", "S9")
    named = variants(spark, row, names="Patient string, SAMPLE string")
    got = omop.measurement_from_variants(named).first()
    assert got["measurement_source_value"] == "S9:PASS" and got["person_id"] is not None
    # Not assigned to anybody unless the caller says so.
    bare = named.drop("Patient", "SAMPLE")
    assert omop.measurement_from_variants(bare).first()["person_id"] is None
    told = omop.measurement_from_variants(bare, default_patient="P9", default_sample="S9").first()
    assert told["person_id"] == got["person_id"] and told["measurement_id"] == got["measurement_id"]
    # The significance is matched as written, or in any case on request.
    assert got["value_as_concept_id"] == 0
    assert omop.measurement_from_variants(named, ignore_case=True).first()["value_as_concept_id"] == 4049393


def test_accepted_and_rejected_make_up_the_input(spark):
    df = spark.createDataFrame(
        [("A", "MALE", "1985-06-15 08:30:00"), ("B", None, "1985-06-15"), ("C", "X", "1985-06-15"),
         ("D", "F", "MALFORMED"), (None, "F", "1985-06-15"), ("E", " unknown ", "1990-01-01")],
        "raw_patient_id string, gender string, birth_datetime string",
    )
    sides = silver.silver_patients(df)
    assert [r[0] for r in rows(sides.accepted.select("raw_patient_id"))] == ["A", "E"]
    assert sides.rejected.count() == 4


def test_variant_filter_drops_null(spark):
    df = spark.createDataFrame([("PASS",), (".",), ("LOW_QUAL",), (None,)], "filter string")
    sides = silver.silver_variants(df)
    assert (sides.accepted.count(), sides.rejected.count()) == (2, 2)


def test_gold_transforms_do_not_shuffle(spark):
    from workload.q_omop import gold

    for df in gold(spark, str(TESTDATA / "sf0.001")).values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan


def test_layout_projection(spark):
    df = spark.range(1)
    shaped = columns.project(df, {"a": F.col("id"), "b": 5}, {"a": "string", "b": "int", "c": "date"})
    assert shaped.schema.simpleString() == "struct<a:string,b:int,c:date>" and tuple(shaped.first()) == ("0", 5, None)
    with pytest.raises(ValueError):
        columns.project(df, {"z": 1}, {"a": "int"})


def test_row_cap_is_reproducible(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 7919 % 1000).repartition(8)
    first = rows(columns.cap_rows(df, 10, ["x"]))
    assert first == rows(columns.cap_rows(df, 10, ["x"])) and len(first) == 10
    assert columns.cap_rows(df, 5).count() == 5


def test_known_answers_on_the_derived_views(spark):
    from workload.catalog import view

    sf_dir = str(TESTDATA / "sf0.01")
    patients = silver.silver_patients(view(spark, sf_dir, "bronze_patients"))
    assert (patients.accepted.count(), patients.rejected.count()) == (1023, 477)
    by_gender = omop.person(patients.accepted).groupBy("gender_concept_id").count()
    assert rows(by_gender) == [(0, 170), (8507, 511), (8532, 342)]
    conditions = omop.condition_occurrence(silver.silver_diagnoses(view(spark, sf_dir, "bronze_diagnoses")).accepted)
    assert (conditions.count(), conditions.where("condition_concept_id = 0").count()) == (13846, 1977)
    measured = omop.measurement_from_labs(silver.silver_labs(view(spark, sf_dir, "bronze_labs")).accepted)
    assert (measured.count(), measured.where("value_as_number IS NULL").count()) == (56366, 8097)
    called = silver.silver_variants(view(spark, sf_dir, "bronze_variants")).accepted
    without_gene = called.where(~F.col("info").contains("GENE=")).count()
    assert (called.count(), without_gene, called.where("qual = '.'").count()) == (1200, 135, 200)


def test_registry_and_conformance(spark):
    listed = registry.registry(spark)
    assert listed.select("table_name").distinct().count() == 4
    assert registry.registered_name(" Person ") == "person"
    with pytest.raises(KeyError):
        registry.registered_name("visit")
    df = spark.createDataFrame(
        [(1, 8507, None, "x"), (2, 8532, 1990, "y")],
        "person_id bigint, gender_concept_id bigint, year_of_birth int, extra string",
    )
    state = {r["column_name"]: r["status"] for r in registry.conformance(df, "person").collect()}
    assert state["person_id"] == "OK" and state["gender_concept_id"] == "TYPE_MISMATCH"
    assert state["year_of_birth"] == "NULLS_IN_REQUIRED" and state["extra"] == "EXTRA"
    assert state["care_site_id"] == "MISSING"
    assert registry.missing_columns(df, "person") == ["race_concept_id", "ethnicity_concept_id"]


def test_vocabulary_tables_give_the_same_gold_rows(spark):
    from clinlake.sources import vocabulary

    table = vocabulary.built_in(spark)
    part = {name: vocabulary.category(table, name) for name in omop.fixed.CONCEPTS}
    df = people(spark, "MALE", "f", None)
    joined = omop.person(df, part["gender_to_concept"], part["race_to_concept"], part["ethnicity_to_concept"])
    assert rows(joined) == rows(omop.person(df))
    coded = diagnoses(spark, "E11.9", "e119", "I100", "zz")
    assert rows(omop.condition_occurrence(coded, part["icd10_to_snomed"])) == rows(omop.condition_occurrence(coded))
