"""Concept look-ups over whole columns, each answer with its target in the OMOP model.

The vocabulary is a dictionary of one category or a vocabulary table; which way it is
looked up is decided by its size alone (``functions.lookup.with_concept``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.fixed_values import CONCEPTS
from clinlake.functions.lookup import dotless_keys, rekeyed, upper_keys, with_concept
from clinlake.functions.parsing import normalise, normalise_dotless
from clinlake.sources.vocabulary import category

Vocabulary = Mapping[str, int] | DataFrame | None
DEMOGRAPHIC_DOMAINS = ("gender", "race", "ethnicity")


def _answer(
    df: DataFrame, query: str, vocabulary_id: str | None, domain_id: str, table: str, field: str
) -> DataFrame:
    """Envelope around ``standard_concept_id``."""
    found = F.col("standard_concept_id") != 0
    named = {
        "domain_id": F.lit(domain_id),
        "target_table": F.lit(table),
        "target_field": F.lit(field),
        "found": found,
        "description": F.when(
            found, F.concat(F.lit(f"{domain_id} concept "), F.col("standard_concept_id"))
        ).otherwise(F.concat(F.lit("no concept for "), F.coalesce(F.col(query), F.lit("NULL")))),
    }
    if vocabulary_id is not None:
        named = {"vocabulary_id": F.lit(vocabulary_id), **named}
    return df.withColumns(named)


def _codes(
    vocabulary: Vocabulary, name: str, column: Column, keys: Callable[[Mapping], dict]
) -> Mapping[str, int] | DataFrame:
    """One category with its codes in another form."""
    if isinstance(vocabulary, DataFrame):
        return category(vocabulary, name).withColumn("source_code", column)
    return keys(CONCEPTS[name] if vocabulary is None else vocabulary)


def _two_step(
    df: DataFrame, exact: Column, codes: Mapping | DataFrame, relaxed: Column, relaxed_codes: Mapping | DataFrame
) -> DataFrame:
    """Look up the exact code first and the relaxed one where that finds nothing."""
    first = with_concept(df, "_exact", exact, codes, "exact")
    second = with_concept(first, "_relaxed", relaxed, relaxed_codes, "exact")
    best = F.coalesce(F.nullif("_exact", F.lit(0)), F.col("_relaxed"))
    return second.withColumn("standard_concept_id", best).drop("_exact", "_relaxed")


def lookup_icd10(df: DataFrame, code: str, vocabulary: Vocabulary = None) -> DataFrame:
    """Diagnosis codes -> SNOMED concepts; as written first, then without dots."""
    name = "icd10_to_snomed"
    clean = df.withColumn("normalized_code", normalise(code))
    resolved = _two_step(
        clean,
        F.col("normalized_code"), _codes(vocabulary, name, normalise("source_code"), upper_keys),
        normalise_dotless(code), _codes(vocabulary, name, normalise_dotless("source_code"), dotless_keys),
    )
    return _answer(
        resolved, code, "SNOMED", "Condition", "CONDITION_OCCURRENCE", "condition_concept_id"
    )


def lookup_loinc(df: DataFrame, code: str, vocabulary: Vocabulary = None) -> DataFrame:
    """Laboratory codes -> measurement concepts."""
    codes = _codes(vocabulary, "loinc_to_concept", normalise("source_code"), upper_keys)
    clean = df.withColumn("normalized_code", normalise(code))
    resolved = with_concept(clean, "standard_concept_id", "normalized_code", codes, "exact")
    return _answer(resolved, code, "LOINC", "Measurement", "MEASUREMENT", "measurement_concept_id")


def _demographic_codes(
    vocabulary: Mapping[str, Mapping[str, int]] | DataFrame | None,
) -> Mapping[str, int] | DataFrame:
    """``domain:code`` of all three domains."""
    if isinstance(vocabulary, DataFrame):
        domain = F.regexp_replace(F.lower("category"), "_to_concept$", "")
        return vocabulary.where(domain.isin(*DEMOGRAPHIC_DOMAINS)).withColumn(
            "source_code", F.concat_ws(":", domain, normalise("source_code"))
        )
    known = CONCEPTS if vocabulary is None else vocabulary
    return {
        f"{name}:{code}": concept
        for name in DEMOGRAPHIC_DOMAINS
        for code, concept in upper_keys(known.get(f"{name}_to_concept", {})).items()
    }


def lookup_demographic(
    df: DataFrame,
    domain: str,
    value: str,
    mappings: Mapping[str, Mapping[str, int]] | DataFrame | None = None,
) -> DataFrame:
    """(domain, value) pairs -> PERSON concepts; an unknown domain gives an ``error``."""
    clean_domain = F.lower(F.trim(F.col(domain)))
    key = F.concat_ws(":", F.col("normalized_domain"), F.col("normalized_value"))
    clean = df.withColumns({"normalized_domain": clean_domain, "normalized_value": normalise(value)})
    resolved = with_concept(clean, "standard_concept_id", key, _demographic_codes(mappings), "exact")
    valid = F.coalesce(F.col("normalized_domain").isin(*DEMOGRAPHIC_DOMAINS), F.lit(False))
    field = F.concat(F.col("normalized_domain"), F.lit("_concept_id"))
    asked = F.coalesce(F.col(domain), F.lit("NULL"))
    message = F.concat(F.lit("unknown demographic domain: "), asked)
    return resolved.withColumns(
        {
            "target_table": F.when(valid, "PERSON"),
            "target_field": F.when(valid, field),
            "found": F.col("standard_concept_id") != 0,
            "error": F.when(~valid, message),
        }
    )


def lookup_clinvar(df: DataFrame, significance: str, vocabulary: Vocabulary = None) -> DataFrame:
    """ClinVar significances -> value concepts; exact spelling first, then any case."""
    name = "clinvar_to_concept"
    resolved = _two_step(
        df,
        F.trim(F.col(significance)), _codes(vocabulary, name, F.col("source_code"), dict),
        F.lower(F.trim(F.col(significance))),
        _codes(vocabulary, name, F.lower("source_code"), lambda entries: rekeyed(entries, str.lower)),
    )
    return _answer(
        resolved, significance, None, "Meas Value", "MEASUREMENT", "value_as_concept_id"
    )
