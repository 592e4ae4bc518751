"""Key buckets that split as a table grows."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinlake.sinks import buckets as linear
from clinlake.sinks.tables import TableStore
from tests.conftest import rows


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(0, 60), st.integers(0, 2**40))
def test_growing_moves_keys_of_split_buckets_only(n, more, h):
    def bucket(count):
        level = count.bit_length() - 1
        low = h % (2 << level)
        return low - (1 << level) if low >= count else low

    before, after = bucket(n), bucket(n + more)
    assert before == after or after >= n and linear.origin(after, n) == before
    assert len(linear.splitting(n, n + more)) <= more and linear.splitting(n, n) == set()


def test_bucket_number_is_the_rule(spark):
    df = spark.range(2_000)
    for n in (1, 2, 3, 7, 8, 9, 100):
        found = df.select(F.xxhash64("id").alias("h"), linear.bucket_number(["id"], n).alias("b")).collect()
        level = n.bit_length() - 1
        assert all(r["b"] == (low - (1 << level) if (low := r["h"] % (2 << level)) >= n else low) for r in found)


def test_a_table_grows_by_splits(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    known, sizes = {}, []
    for size, start in ((3, 0), (400, 2), (1500, 300), (1, 5), (0, 0)):
        df = spark.range(start, start + size).selectExpr("id AS k", f"id * 10 + {size} AS v")
        files = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("part-*.parquet") if "commits" not in str(f)}
        written = store.upsert_touched(df, "t", ["k"], bucket_bytes=4_000)
        known |= {i: i * 10 + size for i in range(start, start + size)}
        assert rows(store.read("gold", "t")) == sorted(known.items())
        kept = {f for f in files if f.exists()}
        assert all(f.stat().st_mtime_ns == files[f] for f in kept)
        if size == 1:  # one key: its bucket alone
            assert len(written) == 1 and len(files) - len(kept) == 1
        sizes.append(max((int(p.name.split("=")[1]) for p in tmp_path.glob("gold/t/*/_bucket__k=*")), default=-1) + 1)
    assert sizes[0] == 1 and sizes[1] > 2 and sizes[2] > sizes[1] and sizes[3] == sizes[2] == sizes[4]
    parts = [p for p in tmp_path.glob("gold/t/v=0+*") if not list(p.glob("_bucket*"))]
    assert not parts  # parts without a bucket of their own are gone


def test_an_upsert_that_dies_is_not_seen(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.upsert_touched(spark.range(50).selectExpr("id AS k", "'old' AS v"), "t", ["k"], buckets=4)
    half = tmp_path / "gold" / "t" / "v=0+0" / "_bucket__k=1"
    spark.range(3).selectExpr("id AS k", "'half' AS v").write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert {r["v"] for r in store.read("gold", "t").collect()} == {"old"}
    store.upsert_touched(spark.range(1).selectExpr("id AS k", "'new' AS v"), "t", ["k"])
    assert sorted(r["v"] for r in store.read("gold", "t").collect()) == ["new"] + ["old"] * 49
    # A part that was complete although its predecessors' folders were not deleted any more:
    one = store._layout("gold", "t", 0).live[0]
    spark.read.parquet(one).write.parquet(str(tmp_path / "gold" / "t" / "v=0+7" / one.rsplit("/", 1)[1]))
    (tmp_path / "gold" / "t" / "v=0+7" / "_SUCCESS").touch()
    assert store.read("gold", "t").count() == 50


def test_buckets_that_lose_all_their_keys(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    keys = [i for i, b in spark.range(400).select("id", linear.bucket_number(["id"], 2)).collect() if b == 1]
    moved = [i for i, b in spark.range(400).select("id", linear.bucket_number(["id"], 4)).collect() if b == 3]
    only = spark.createDataFrame([(i, "a") for i in moved], "k bigint, v string")
    assert set(moved) <= set(keys)
    store.upsert_touched(only, "t", ["k"], buckets=2)
    one_more = spark.createDataFrame([(moved[0], "b")], "k bigint, v string")
    assert store.upsert_touched(one_more, "t", ["k"], bucket_bytes=max(1, store.size_of(str(tmp_path / "gold" / "t")) // 3)) == [3]
    assert sorted(r["k"] for r in store.read("gold", "t").collect()) == moved


def test_layouts_by_other_keys_and_names(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), schema="default")
    rows_of = lambda *data: spark.createDataFrame(list(data), "`k 1` int, note string, v int")
    name = "grown_" + tmp_path.name.replace("-", "_")
    store.write_gold(rows_of((1, "a", 1), (2, "b", 1)), name, cluster_by=[])
    assert spark.table(f"default.{name}").count() == 2
    with pytest.raises(ValueError):
        store.upsert_touched(rows_of((1, "c", 2)), name, ["k 1"])
    try:
        store.upsert_touched(rows_of((1, "c", 2), (None, "n", 0)), name, ["k 1"], relay=True, buckets=3)
        assert rows(store.read("gold", name)) == [(None, "n", 0), (1, "c", 2), (2, "b", 1)]
        store.upsert_touched(rows_of((3, "d", 2)), name, ["k 1"], bucket_bytes=100)
        assert rows(spark.table(f"default.{name}")) == rows(store.read("gold", name)) and store.read("gold", name).count() == 4
        with pytest.raises(ValueError):
            store.upsert_touched(rows_of((3, "d", 2)), name, ["note"])
        with pytest.raises(ValueError):
            store.write_gold(rows_of((9, "z", 9)), name, cluster_by=[], mode="append")
        store.write_gold(rows_of((9, "z", 9)), name, cluster_by=[])
        store.write_gold(rows_of((8, "y", 9)), name, cluster_by=[])
        assert rows(spark.table(f"default.{name}")) == [(8, "y", 9)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS default.{name}")
    with pytest.raises(ValueError):
        linear.bucket_column(["a__b"])
