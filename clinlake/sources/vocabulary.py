"""Vocabularies as a long table ``(category, source_code, concept_id)``."""

from __future__ import annotations

import os
from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.fixed_values import CONCEPTS
from clinlake.functions.lookup import usable_entries
from clinlake.functions.parsing import as_column
from clinlake.sources import listing
from clinlake.sources.jsonscan import RANGE_BYTES, scan_entries
from clinlake.workspace import path_exists

PATH_VARIABLE = "CLINLAKE_VOCABULARY"
ROW_LAYOUT = "category STRING, source_code STRING, concept_id INT"


def entries_of(documents: DataFrame, document: Column | str = "value") -> DataFrame:
    """Vocabulary rows of JSON documents ``{category: {code: concept_id}}``.

    Categories and codes starting with ``_`` are remarks; entries whose id is not
    an integer are left out. Both levels are read as maps, so that any category
    name is accepted. Parsing takes far longer than reading, so the documents are
    dealt over tasks first, however few files they are in.
    """
    texts = listing.dealt(documents.select(as_column(document).alias("value")))
    sections = texts.select(F.explode(F.from_json("value", "map<string,string>")).alias("category", "body"))
    codes = sections.where(~F.col("category").startswith("_")).select(
        "category", F.explode(F.from_json("body", "map<string,string>")).alias("code", "concept")
    )
    return codes.where(~F.col("code").startswith("_")).select(
        "category",
        F.col("code").alias("source_code"),
        F.col("concept").try_cast("int").alias("concept_id"),
    ).where(F.col("concept_id").isNotNull())


def scanned_entries(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Vocabulary rows of JSON files of any size; a large one is read by many tasks."""
    entries = scan_entries(spark, path, range_bytes)
    return entries.where(~F.col("section").startswith("_") & ~F.col("key").startswith("_")).select(
        F.col("section").alias("category"), F.col("key").alias("source_code"),
        F.col("value").try_cast("int").alias("concept_id"),
    ).where(F.col("concept_id").isNotNull())


def built_in(spark: SparkSession) -> DataFrame:
    """The vocabulary that ships with the package."""
    return from_mappings(spark, CONCEPTS)


def from_mappings(spark: SparkSession, mappings: Mapping[str, Mapping[str, int]]) -> DataFrame:
    rows = [
        (category, code, concept)
        for category, mapping in mappings.items()
        for code, concept in usable_entries(mapping).items()
    ]
    return spark.createDataFrame(rows, ROW_LAYOUT)


def with_fallback(loaded: DataFrame, fallback: DataFrame) -> DataFrame:
    """Loaded rows, plus the fallback's rows of categories that were not loaded at all."""
    known = loaded.select("category").distinct()
    return loaded.unionByName(fallback.join(known, "category", "left_anti"))


def vocabulary_path(path: str | None = None) -> str | None:
    """Explicit path first, then the environment variable; None means built-in."""
    return path or os.environ.get(PATH_VARIABLE) or None


def load_vocabulary(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Vocabulary table of one or many JSON files, categories missing there built in."""
    chosen = vocabulary_path(path)
    if chosen is None or not path_exists(spark, chosen):
        return built_in(spark)
    if all(listing.knows(r) for r in listing.roots(spark, chosen)):
        loaded = scanned_entries(spark, chosen)
    else:
        loaded = entries_of(spark.read.text(chosen, wholetext=True))
    return with_fallback(loaded, built_in(spark))


def category(vocabulary: DataFrame, name: str) -> DataFrame:
    """Rows of one category, by name in any case."""
    return vocabulary.where(F.lower("category") == name.strip().lower())


# One accessor per category of the OMOP build.
icd10_concepts = partial(category, name="icd10_to_snomed")
loinc_concepts = partial(category, name="loinc_to_concept")
gender_concepts = partial(category, name="gender_to_concept")
race_concepts = partial(category, name="race_to_concept")
ethnicity_concepts = partial(category, name="ethnicity_to_concept")
clinvar_concepts = partial(category, name="clinvar_to_concept")


def query_vocabulary(vocabulary: DataFrame, name: str | None = None) -> DataFrame:
    """The whole vocabulary or one category; an unknown category is an error."""
    if name is None:
        return vocabulary
    rows = category(vocabulary, name)
    if rows.isEmpty():
        known = sorted(r["category"] for r in vocabulary.select("category").distinct().collect())
        raise ValueError(f"unknown category {name!r}; available: {', '.join(known)}")
    return rows


def categories(vocabulary: DataFrame) -> DataFrame:
    """The categories of a vocabulary and how many codes each holds."""
    return vocabulary.groupBy("category").agg(F.count(F.lit(1)).alias("codes"))


def drift(old: DataFrame, new: DataFrame, changed_only: bool = True) -> DataFrame:
    """Codes with another concept in ``new``; optionally added and removed ones too."""
    keys = ["category", "source_code"]
    before = old.select(*keys, F.col("concept_id").alias("old_concept_id"))
    after = new.select(*keys, F.col("concept_id").alias("new_concept_id"))
    # Spark takes entries for as few as the bytes of the files that their documents are in.
    joined = before.hint("merge").join(after, keys, "inner" if changed_only else "full_outer")
    kind = (
        F.when(F.col("old_concept_id").isNull(), "added")
        .when(F.col("new_concept_id").isNull(), "removed")
        .otherwise("changed")
    )
    differs = ~F.col("old_concept_id").eqNullSafe(F.col("new_concept_id"))
    return joined.where(differs).withColumn("change", kind)
