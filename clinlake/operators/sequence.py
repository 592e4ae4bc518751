"""Consecutive rows of numbered sequences, without one task per sequence.

A window over a whole sequence would put all of its rows into one task. Here the
numbers are cut at fixed bit positions: the lowest 21 bits number the rows within
a segment, the next 21 bits the segments within a block, the rest the blocks. Each
level compares neighbours inside its own group and hands the group's first and last
row up to the next level. A group has at most 2**21 members, whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEVEL_BITS = 21


def neighbours(
    df: DataFrame, keys: Sequence[str], number: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Pairs of consecutive rows per sequence, in the order of a non-negative number.

    ``number`` has to be unique within ``keys``. Returns the keys and, for the number
    and each carried column, its value in the earlier (``prev_``) and later (``next_``)
    row.
    """
    wanted = [number, *carry]
    level = df.select(
        *keys,
        F.struct(*wanted).alias("first"),
        F.struct(*wanted).alias("last"),
        F.col(number).cast("bigint").alias("place"),
    )
    pairs: DataFrame | None = None
    for depth in range(3):
        top = depth == 2
        group = F.lit(0).cast("bigint") if top else F.shiftright("place", LEVEL_BITS)
        # Both uses of a level read the same exchange, so it is shuffled once.
        level = level.withColumn("grp", group).repartition(*keys, "grp")
        in_group = W.partitionBy(*keys, "grp").orderBy("place")
        linked = level.withColumn("before", F.lag("last").over(in_group))
        found = linked.where(F.col("before").isNotNull()).select(
            *keys,
            *[F.col(f"before.{c}").alias(f"prev_{c}") for c in wanted],
            *[F.col(f"first.{c}").alias(f"next_{c}") for c in wanted],
        )
        pairs = found if pairs is None else pairs.unionByName(found)
        if not top:
            level = (
                level.groupBy(*keys, "grp")
                .agg(
                    F.min_by("first", "place").alias("first"),
                    F.max_by("last", "place").alias("last"),
                )
                .withColumnRenamed("grp", "place")
            )
    return pairs


def gaps(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Missing runs of numbers: ``(keys, gap_start, gap_end, missing)``."""
    before, after = F.col(f"prev_{number}"), F.col(f"next_{number}")
    return neighbours(df, keys, number).where(after - before > 1).select(
        *keys,
        (before + 1).alias("gap_start"),
        (after - 1).alias("gap_end"),
        (after - before - 1).alias("missing"),
    )


def continuity(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Whether the numbers of each sequence are one run without gap or repeat."""
    spread = df.groupBy(*keys).agg(
        F.min(number).alias("first_number"),
        F.max(number).alias("last_number"),
        F.count(number).alias("members"),
        F.count_distinct(number).alias("different"),
    )
    span = F.col("last_number") - F.col("first_number") + 1
    whole = (F.col("members") == F.col("different")) & (span == F.col("members"))
    return spread.withColumn("is_continuous", whole).drop("different")


def setbacks(df: DataFrame, keys: Sequence[str], number: str, value: str) -> DataFrame:
    """Places where the value falls from one row to the next; NULL values are passed over."""
    known = df.where(F.col(value).isNotNull())
    return neighbours(known, keys, number, [value]).where(
        F.col(f"next_{value}") < F.col(f"prev_{value}")
    )
