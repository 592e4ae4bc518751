"""A training corpus in five stages: language, near-duplicates, benchmark leaks, personal data, mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import decontamination, language_id, near_dup, surrogates
from clinlake.llm.common import saved, table
from clinlake.llm.mixture import Mixture

MIX_BLOCK_WORDS = 256
MIX_SHARD_SLOTS = 1024


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; ``lang`` becomes the predicted one."""
    return language_id.relabel(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dup.deduplicate(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    replaced = surrogates.replace_entities(docs).select(docs.columns)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return replaced


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as pieces of text: shard, slot, source, block, and which words of which document."""
    mix = Mixture(docs, block_words=MIX_BLOCK_WORDS, shard_slots=MIX_SHARD_SLOTS, keep_text=True)
    return mix.pieces().drop("nth", "start")


STAGES = [
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: Language models, signatures, surrogates and draws are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = saved(spark, docs, name)
    return docs
