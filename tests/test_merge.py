"""Upsert, de-duplication, snapshot difference, sequences."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinlake.functions.lookup import row_bytes, text_bytes
from clinlake.operators import merge, sequence
from tests.conftest import TESTDATA, rows

LAYOUT = "k int, v string, n int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), LAYOUT)


def test_dedup_keeps_the_latest_and_is_deterministic(spark):
    df = frame(spark, (1, "a", 1), (1, "b", 3), (1, "c", 3), (2, "x", None), (2, "y", 0), (None, "p", 1), (None, "q", 2))
    expected = [(None, "q", 2), (1, "c", 3), (2, "y", 0)]
    for parts in (1, 5):
        assert rows(merge.dedup_keys(df.repartition(parts), ["k"], ["n"])) == expected


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = merge.dedup_keys(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    shuffle, partial = plan.index("Exchange"), plan.rindex("WindowGroupLimit")
    assert partial > shuffle  # deeper in the plan: before the exchange


def test_upsert_replaces_inserts_and_keeps(spark):
    target = frame(spark, (1, "old", 1), (2, "old", 1), (None, "old", 1))
    source = frame(spark, (2, "new", 1), (2, "newer", 2), (3, "new", 1), (None, "new", 1))
    merged = merge.upsert(target, source, ["k"], ["n"])
    assert rows(merged) == [(None, "new", 1), (1, "old", 1), (2, "newer", 2), (3, "new", 1)]
    assert rows(merge.upsert(merged, source, ["k"], ["n"])) == rows(merged)
    assert rows(merge.upsert(target, source, ["k"], ["n"], small_source=True)) == rows(merged)
    plain = merge.upsert(target, source, ["k"], ["n"], null_safe=False)
    assert plain.where("k IS NULL").count() == 2


def test_an_upsert_ranks_its_source_once_and_measures_no_numbers(spark):
    target, source = frame(spark, (1, "old", 1), (None, "old", 1)), frame(spark, (1, "new", 1), (1, "newer", 2), (None, "new", 1), (3, None, None))
    merged = merge.upsert(target, source, ["k"], ["n"])
    assert rows(merged) == [(None, "new", 1), (1, "newer", 2), (3, None, None)]
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    typed = source.select("k", "n", F.current_timestamp().alias("t"), F.lit(1.5).alias("d"), F.current_date().alias("on"))
    measured = typed.agg(F.sum(row_bytes(typed)))._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in measured
    assert text_bytes(frame(spark, (1, "abc", None))) >= 16 + 1 + 3  # no less than the text


def test_upsert_schemas(spark):
    target, wide = frame(spark, (1, "a", 1)), frame(spark, (1, "b", 2)).withColumn("w", F.lit("x"))
    with pytest.raises(ValueError):
        merge.upsert(target, wide, ["k"])
    with pytest.raises(ValueError):
        merge.upsert(wide, target, ["k"])
    assert rows(merge.upsert(target, wide, ["k"], merge_schema=True)) == [(1, "b", 2, "x")]


def test_merge_statement_needs_a_table_that_can_change_rows(spark):
    frame(spark, (1, "a", 1)).write.mode("overwrite").saveAsTable("plain_target")
    try:
        with pytest.raises(Exception, match="(?i)merge"):
            merge.merge_into(frame(spark, (1, "b", 2)), "plain_target", ["k"])
    finally:
        spark.sql("DROP TABLE plain_target")


def test_upsert_of_orders(spark):
    orders = spark.read.parquet(str(TESTDATA / "sf0.01" / "orders.parquet"))
    target, source = orders.where("o_orderkey < 10000"), orders.where("o_orderkey >= 8000")
    once = merge.upsert(target, source, ["o_orderkey"])
    assert once.count() == 15_000
    twice = merge.upsert(once, source, ["o_orderkey"])
    assert merge.snapshot_diff(once, twice, ["o_orderkey"]).count() == 0


def test_snapshot_difference(spark):
    old = frame(spark, (1, "a", 1), (2, "b", 1), (3, "c", 1), (None, "z", 1))
    new = frame(spark, (1, "a", 1), (2, "B", 1), (4, "d", 1), (None, "Z", 1))
    assert rows(merge.snapshot_diff(old, new, ["k"])) == [
        (None, "Z", 1, "update_postimage"), (None, "z", 1, "update_preimage"), (2, "B", 1, "update_postimage"),
        (2, "b", 1, "update_preimage"), (3, "c", 1, "delete"), (4, "d", 1, "insert"),
    ]


def test_snapshot_difference_counts_copies(spark):
    old = frame(spark, (1, "a", 1), (1, "a", 1), (1, "a", 1))
    new = frame(spark, (1, "a", 1))
    assert rows(merge.snapshot_diff(old, new, ["k"])) == [(1, "a", 1, "delete")] * 2


TABLES = st.dictionaries(st.integers(0, 8), st.sampled_from("abc"), max_size=6)


@settings(max_examples=8, deadline=None)
@given(TABLES, TABLES)
def test_applying_a_difference_gives_the_new_snapshot(spark, before, after):
    def snapshot(content):
        return spark.createDataFrame([(k, v) for k, v in content.items()], "k int, v string")

    old, new = snapshot(before), snapshot(after)
    changes = merge.snapshot_diff(old, new, ["k"])
    assert rows(merge.apply_changes(old, changes, ["k"])) == rows(new)


# -- sequences ----------------------------------------------------------------------

BIG = 1 << 21


def brute_pairs(numbers):
    ordered = sorted(numbers)
    return list(zip(ordered, ordered[1:], strict=False))


@settings(max_examples=10, deadline=None)
@given(
    st.sets(
        st.one_of(
            st.integers(0, 10),
            st.integers(BIG - 3, BIG + 3),
            st.integers(BIG * BIG - 2, BIG * BIG + 2),
            st.integers(0, 2**62),
        ),
        min_size=1,
        max_size=12,
    )
)
def test_neighbours_equal_a_sorted_list(spark, numbers):
    df = spark.createDataFrame([("t", n, f"v{n}") for n in numbers], "t string, n bigint, v string")
    got = rows(sequence.neighbours(df, ["t"], "n", ["v"]).select("prev_n", "next_n", "prev_v", "next_v"))
    assert got == sorted((a, b, f"v{a}", f"v{b}") for a, b in brute_pairs(numbers))


def test_gaps_and_setbacks_per_table(spark):
    df = spark.createDataFrame(
        [("a", 0, 5), ("a", 1, None), ("a", 4, 4), ("a", 5, 4), ("b", 7, 1), ("b", 8, 2), ("a", BIG + 1, 9)],
        "t string, n bigint, ts bigint",
    )
    assert rows(sequence.gaps(df, ["t"], "n")) == [("a", 2, 3, 2), ("a", 6, BIG, BIG - 5)]
    assert rows(sequence.setbacks(df, ["t"], "n", "ts").select("t", "prev_n", "next_n")) == [("a", 0, 4)]
    assert rows(sequence.continuity(df, ["t"], "n").select("t", "is_continuous")) == [("a", False), ("b", True)]


def test_repeated_numbers_are_not_continuous(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("a", 2)], "t string, n bigint")
    assert not sequence.continuity(df, ["t"], "n").first()["is_continuous"]


def test_snapshot_diff_tasks_hold_about_as_many_rows_at_every_size(spark):
    for n in (2000, 8000):
        old = spark.range(n).selectExpr("id % 700 AS k", "id AS v")
        found = merge.snapshot_diff(old, old.selectExpr("k", "v + 1000000 AS v"), ["k"], hot_rows=100, part_rows=200)
        per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 2 * n and max(per_task) < 1500
