"""Scalar functions, keys and look-ups."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinlake.fixed_values import CONCEPTS
from clinlake.functions import keys, lookup, parsing
from clinlake.operators.concept_tools import (
    lookup_clinvar, lookup_demographic, lookup_icd10, lookup_loinc,
)
from clinlake.sources import vocabulary
from tests.conftest import rows


def strings(spark, *values, name="x"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def column(df, expression):
    return [r["v"] for r in df.withColumn("v", expression).orderBy("i").collect()]


def test_timestamps_dates_and_numbers_never_raise(spark):
    df = strings(spark, "2023-03-15 11:30:00", "1985-06-15", "MALFORMED", None, "")
    assert column(df, parsing.safe_timestamp("x")) == [
        datetime(2023, 3, 15, 11, 30), datetime(1985, 6, 15), None, None, None,
    ]
    assert column(df, parsing.safe_date("x")) == [date(2023, 3, 15), date(1985, 6, 15), None, None, None]
    assert column(strings(spark, "1985"), parsing.safe_date("x")) == [date(1985, 1, 1)]
    numbers = strings(spark, "7.8", "Positive", None)
    assert column(numbers, parsing.safe_number("x")) == [7.8, None, None]


def test_quality_marks_read_as_zero(spark):
    df = strings(spark, "99.5", ".", None, "high")
    assert column(df, parsing.number_or_zero("x")) == [99.5, 0.0, 0.0, 0.0]


def test_codes_meet_after_normalising(spark):
    df = strings(spark, "E11.9", " e119 ", "I10")
    assert column(df, parsing.normalise_dotless("x")) == ["E119", "E119", "I10"]


def test_info_keys_are_anchored(spark):
    df = strings(spark, "GENE=BRCA1;CLNSIG=Benign", "XGENE=A;AF=1", "AF=1;GENE=TP53", None)
    assert column(df, parsing.info_value("x", "GENE")) == ["BRCA1", "", "TP53", None]


def test_digest_format(spark):
    good = hashlib.sha256(b"x").hexdigest()
    df = strings(spark, good, good.upper(), f" {good} ", None, "", good[:-1], good + "0", "z" * 64)
    assert column(df, parsing.is_sha256("x")) == [True, True, True] + [False] * 5


def test_instants_become_iso_text(spark):
    df = strings(spark, "2020-01-02 03:04:05").withColumn("t", F.col("x").cast("timestamp"))
    assert column(df, parsing.iso_text("t", df.schema["t"].dataType)) == ["2020-01-02T03:04:05Z"]
    assert column(df, parsing.iso_text("x", df.schema["x"].dataType)) == ["2020-01-02 03:04:05"]


def test_keys_are_stable_non_negative_and_null_for_null(spark):
    df = strings(spark, *[f"PAT_{i}" for i in range(500)], None)
    for style in keys.KEY_STYLES:
        values = column(df, keys.surrogate_key("x", style=style))
        assert values[-1] is None
        assert all(v >= 0 for v in values[:-1])
        assert len(set(values[:-1])) == 500


def test_absolute_keys_equal_the_absolute_hash(spark):
    df = strings(spark, *[f"PAT_{i}" for i in range(100)])
    expected = column(df, F.abs(F.xxhash64("x")))
    assert column(df, keys.surrogate_key("x", style="absolute")) == expected


def test_key_of_the_smallest_hash_does_not_overflow(spark):
    smallest = F.lit(keys.SMALLEST_LONG)
    guarded = F.when(smallest == F.lit(keys.SMALLEST_LONG), F.lit(keys.LARGEST_KEY)).otherwise(F.abs(smallest))
    row = spark.range(1).select(guarded.alias("a"), smallest.bitwiseAND(F.lit(keys.LARGEST_KEY)).alias("m"))
    assert tuple(row.first()) == (keys.LARGEST_KEY, 0)


def test_absent_key_parts_do_not_collide(spark):
    df = spark.createDataFrame(
        [(0, "a", None, "b"), (1, "a", "b", None), (2, None, None, None)], "i int, x string, y string, z string"
    )
    first, second, nothing = column(df, keys.surrogate_key("x", "y", "z"))
    assert first != second and nothing is None


def test_unknown_key_style_is_refused():
    with pytest.raises(ValueError):
        keys.surrogate_key("x", style="md5")


def test_lookup_skips_remarks_and_unusable_entries(spark):
    mapping = {"_description": "x", "_comment_A": 5, "CODE_A": 1001, "CODE_B": "1002", "BAD": "none", "NIL": None}
    df = strings(spark, "CODE_A", "CODE_B", "UNMAPPED", None, "BAD", "_comment_A")
    assert column(df, lookup.concept_of("x", mapping)) == [1001, 1002, 0, 0, 0, 0]
    assert column(df, lookup.concept_of("x", {}, default=7)) == [7] * 6
    assert column(df, lookup.concept_of("x", {"_only": 1})) == [0] * 6


@pytest.mark.parametrize("broadcast_bytes", [lookup.BROADCAST_BYTES, 0])
def test_map_and_join_agree(spark, broadcast_bytes):
    df = strings(spark, "4548-4", "2345-7", "9999-9", None, "4548-4")
    table = vocabulary.category(vocabulary.built_in(spark), "loinc_to_concept")
    joined = lookup.join_concepts(df, "x", table, "v", broadcast_bytes=broadcast_bytes)
    expected = column(df, lookup.concept_of("x", CONCEPTS["loinc_to_concept"]))
    assert [r["v"] for r in joined.orderBy("i").collect()] == expected


def test_repeated_codes_do_not_multiply_rows(spark):
    table = spark.createDataFrame([("A", 2), ("A", 1), (None, 9), ("B", None)], "source_code string, concept_id int")
    joined = lookup.join_concepts(strings(spark, "A", "B", None), "x", table, "v")
    assert [(r["i"], r["v"]) for r in joined.orderBy("i").collect()] == [(0, 1), (1, 0), (2, 0)]


def test_join_plan_broadcasts_only_what_is_small(spark):
    df = strings(spark, "A")
    table = spark.createDataFrame([("A", 1)], "source_code string, concept_id int")
    small = lookup.join_concepts(df, "x", table, "v")._jdf.queryExecution().toString()
    assert "ResolvedHint (strategy=broadcast)" in small or "BroadcastHashJoin" in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = lookup.join_concepts(df, "x", table, "v", broadcast_bytes=0)
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert large.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_large_dictionary_is_joined(spark):
    entries = {f"C{i}": i for i in range(1_000_000)}
    joined = lookup.with_concept(strings(spark, "c7", "C999999", "x"), "v", "x", entries)
    assert "Join" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert [r["v"] for r in joined.orderBy("i").collect()] == [7, 999_999, 0]


@pytest.mark.parametrize("unused", [0, 300])
def test_colliding_codes_have_one_meaning_at_every_size(spark, unused):
    df = strings(spark, "e119", "E11.9", " e11.9")
    for pairs in ({"e119": 100, "E11.9": 900}, {"E11.9": 900, "e119": 100}, {"e119": 900, "E11.9": 100}):
        entries = pairs | {f"U{i}": i for i in range(unused)}
        table = spark.createDataFrame(list(entries.items()), "source_code string, concept_id int")
        for vocabulary in (entries, table):
            found = lookup.with_concept(df, "v", "x", vocabulary, "dotless").select("v").distinct().collect()
            assert [r["v"] for r in found] == [100]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(["E11.9", "i10 ", "j45909", "zz", ""])), min_size=1, max_size=20))
def test_icd10_lookup_equals_a_dictionary_probe(spark, codes):
    table = {k.replace(".", ""): v for k, v in CONCEPTS["icd10_to_snomed"].items()}
    expected = [0 if c is None else table.get(c.strip().upper().replace(".", ""), 0) for c in codes]
    assert column(strings(spark, *codes), lookup.icd10_concept_of("x", CONCEPTS["icd10_to_snomed"])) == expected


# -- bulk look-up tools -------------------------------------------------------------


def test_icd10_tool_hits_and_misses(spark):
    found = lookup_icd10(strings(spark, "E11.9", "i10", "C3490", "Z99.9", None), "x").orderBy("i").collect()
    assert [r["standard_concept_id"] for r in found] == [201826, 316866, 254637, 0, 0]
    assert [r["found"] for r in found] == [True, True, True, False, False]
    assert found[0]["vocabulary_id"] == "SNOMED" and found[0]["target_table"] == "CONDITION_OCCURRENCE"


def test_tools_give_the_same_answers_from_a_vocabulary_table(spark):
    table = vocabulary.built_in(spark)
    codes = strings(spark, "E11.9", "e119", "Z00", None)
    for tool, df in (
        (lookup_icd10, codes),
        (lookup_loinc, strings(spark, " 4548-4", "2160-0", "x", None)),
        (lookup_clinvar, strings(spark, "Pathogenic", "BENIGN", "x", None)),
    ):
        assert rows(tool(df, "x"), "i") == rows(tool(df, "x", table).select(*tool(df, "x").columns), "i")


def test_clinvar_tool_ignores_case_only_as_a_fallback(spark):
    mapping = {"Benign": 1, "BENIGN": 2}
    got = lookup_clinvar(strings(spark, "Benign", "BENIGN"), "x", mapping).orderBy("i").collect()
    assert [r["standard_concept_id"] for r in got] == [1, 2]


def test_demographic_tool_reports_unknown_domains(spark):
    df = spark.createDataFrame(
        [("gender", " male"), ("Race", "asian"), ("ethnicity", "x"), ("shoe", "42")], "d string, v string"
    )
    got = {r["d"]: r for r in lookup_demographic(df, "d", "v").collect()}
    assert got["gender"]["standard_concept_id"] == 8507 and got["gender"]["target_field"] == "gender_concept_id"
    assert got["Race"]["standard_concept_id"] == 8515
    assert got["ethnicity"]["found"] is False and got["ethnicity"]["error"] is None
    assert got["shoe"]["error"] and got["shoe"]["standard_concept_id"] == 0


def test_salted_join_spreads_a_hot_code(spark):
    df = spark.range(30_000).selectExpr("id", "IF(id % 3 = 0, 'HOT', concat('c', id)) AS x")
    table = spark.range(1000).selectExpr("concat('c', id) AS source_code", "CAST(id AS INT) AS concept_id")
    table = table.unionByName(spark.createDataFrame([("HOT", 7)], "source_code string, concept_id int"))
    settings = {
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup.join_concepts(df, "x", table, "v", broadcast_bytes=0, hot_rows=500)
        hot = joined.where("x = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in hot) == 10_000 and max(r["count"] for r in hot) < 5_000
        assert joined.where("x = 'HOT' AND v <> 7").count() == 0 and joined.count() == 30_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_large_dictionaries_are_joined(spark):
    large = {f"c.{i}": i for i in range(lookup.MAP_LITERAL_ENTRIES + 1)}
    df = strings(spark, "C.7", "c200", "zz", None)
    small = lookup.with_concept(df, "v", "x", {"c.7": 7, "c.200": 200}, form="dotless")
    joined = lookup.with_concept(df, "v", "x", large, form="dotless")
    assert rows(small) == rows(joined) == [(0, "C.7", 7), (1, "c200", 200), (2, "zz", 0), (3, None, 0)]
    assert "Join" in joined._jdf.queryExecution().toString()
    assert "Join" not in small._jdf.queryExecution().toString()
