"""Left joins with a table of one row per key, whatever the keys of the other side are like."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key with more rows than this is dealt over parts of about as many rows.
HOT_ROWS = 1_000_000
# Rows without a key meet nothing and are dealt over so many parts.
NULL_PARTS = 4096


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def row_hash(df: DataFrame) -> F.Column:
    """Hash over a row's columns (maps cannot be hashed; columns with one at any depth are left out)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)])


# What the sketch of frequent keys holds per task, and how many keys it names at most.
TRACKED_KEYS = 65_536
NAMED_KEYS = 10_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, tracked: int = TRACKED_KEYS) -> list[tuple[int, int]]:
    """(hash of the key, parts) of the keys with more than about ``hot_rows`` rows.

    Every task keeps a sketch of a bounded number of counters; merged they name every key
    that has more than a ``tracked``-th part of the rows or so, and too high a count rather
    than too low a one. Keys are not shuffled. Only speed depends on the answer.
    """
    named = min(NAMED_KEYS, tracked)
    sketch = F.expr(f"approx_top_k(xxhash64(`{key}`), {named}, {tracked})")
    found = df.where(F.col(key).isNotNull()).agg(sketch.alias("top")).first()["top"] or []
    return [(r["item"], -(-r["count"] // hot_rows)) for r in found if r["count"] > hot_rows]


def left_join_split(
    df: DataFrame, single: DataFrame, key: str, hot_rows: int = HOT_ROWS, counted: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``df`` left-joined on ``key`` with ``single``, which has one row per key.

    Hot keys come from a sketch: their rows are dealt over as many parts as their count
    asks for, and only their rows of ``single`` are copied as often. Rows without a key are
    dealt over many parts. ``counted`` may name a cheaper table with the same keys to count,
    ``parts`` the number of tasks that join.
    """
    long = lambda n: F.lit(n).cast("bigint")
    hot = hot_keys(df if counted is None else counted, key, hot_rows)
    place, hashed = row_hash(df), F.xxhash64(F.col(key))
    if not hot:
        # Always 0, but not a constant, which the optimizer would take out of the join's keys.
        width, sides, copies = long(1), df, single.withColumn("_part", F.pmod(F.xxhash64(key), long(1)))
    else:
        # At most NAMED_KEYS rows; once for each side, so that each has columns of its own.
        named = [df.sparkSession.createDataFrame(hot, f"{h} bigint, {n} bigint") for h, n in (("_wide", "_width"), ("_hot", "_parts"))]
        sides = df.join(F.broadcast(named[0]), hashed == F.col("_wide"), "left").drop("_wide")
        width = F.coalesce("_width", long(1))
        copies = single.join(F.broadcast(named[1]), hashed == F.col("_hot"), "left").withColumn(
            "_part", F.explode(F.sequence(long(0), F.coalesce("_parts", long(1)) - 1))
        ).drop("_hot", "_parts")
    salted = sides.withColumn(
        "_part", F.pmod(place, F.when(F.col(key).isNull(), long(NULL_PARTS)).otherwise(width))
    ).drop("_width")
    if parts is not None:
        salted, copies = (side.repartition(parts, key, "_part") for side in (salted, copies))
    return salted.join(copies, [key, "_part"], "left").drop("_part")
