"""The operators of this folder over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinlake.llm import (
    decontamination, html_text, language_id, mixture, near_dup, quality, resampling, spelling, surrogates, token_counts, topk,
    toxicity, warc,
)
from clinlake.llm.common import table

VOCABULARY = "word_bpe_49k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.Mixture(table(spark, sf_dir, "documents")).taken()


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_list(table(spark, sf_dir, "pages"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_html_text, op3_topk_search, op4_quality, op5_surrogates, op6_language, op7_toxicity,
        op8_near_duplicates, op9_mixture, op10_decontamination, op11_spelling_variants, op12_warc_archives,
        op13_importance_resampling,
    )
}
ORACLES: dict[str, str] = {
    "op3_topk_search": topk.ORACLE, "op8_near_duplicates": near_dup.ORACLE, "op11_spelling_variants": spelling.ORACLE,
    "op12_warc_archives": warc.ORACLE, "op13_importance_resampling": resampling.ORACLE,
}
