"""Keyed upsert, de-duplication and snapshot difference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinlake.functions.joins import HOT_ROWS, left_join_split
from clinlake.functions.lookup import BROADCAST_BYTES, size_at_most


def dedup_keys(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the greatest ``latest_by`` values.

    All remaining columns break ties, so the survivor is the same on every run.
    Spark keeps only the first row per key before the shuffle, so a key with very
    many copies costs each task one row.
    """
    others = [c for c in df.columns if c not in keys and c not in latest_by]
    order = [F.desc_nulls_last(c) for c in [*latest_by, *others]] or [F.lit(1)]
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def _same_keys(
    keys: Sequence[str], null_safe: bool, target: str = "t", source: str = "s"
) -> Column:
    pairs = [(F.col(f"{target}.{k}"), F.col(f"{source}.{k}")) for k in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str] = (),
    null_safe: bool = True,
    small_source: bool | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """State of ``target`` after upserting ``source`` (matched: replace, else: insert).

    The source is de-duplicated first. Only its keys enter the join. ``null_safe``
    lets NULL keys match each other, which keeps reruns idempotent. Set
    ``small_source`` after a size check to spare the target the shuffle; left open,
    the runtime statistics decide.
    """
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks columns of the target: {missing}")
    extra = [c for c in source.columns if c not in target.columns]
    if extra and not merge_schema:
        raise ValueError(f"source has columns the target does not have: {extra}")
    changed = dedup_keys(source, keys, latest_by)
    # The keys are those of the source as it is: nothing has to be ranked to know them.
    changed_keys = source.select(*keys).distinct().alias("s")
    if small_source:
        changed_keys = F.broadcast(changed_keys)
    untouched = target.alias("t").join(changed_keys, _same_keys(keys, null_safe), "left_anti")
    return untouched.unionByName(changed, allowMissingColumns=merge_schema)


def merge_into(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    latest_by: Sequence[str] = (),
    null_safe: bool = True,
) -> None:
    """The same upsert as a MERGE, for catalog tables that can change single rows."""
    same = _same_keys(keys, null_safe, target=table, source="source")
    merge = dedup_keys(source, keys, latest_by).alias("source").mergeInto(table, same)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def source_is_small(source: DataFrame, keys: Sequence[str], size: int = BROADCAST_BYTES) -> bool:
    """Checked size, in bytes, of the side that an upsert would broadcast."""
    return size_at_most(source.select(*keys), size)


#: Rows that a task of a snapshot difference gets, about; packed for a shuffle they may be so small that bytes say little.
ROWS_A_PART = 1_000_000


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, part_rows: int = ROWS_A_PART
) -> DataFrame:
    """Rows that differ between two snapshots, with ``change_type``.

    ``insert``, ``delete``, or ``update_preimage`` and ``update_postimage`` for a
    key that both have with other contents. Equal rows are counted off against each
    other before any key is looked at, so repeated rows and repeated keys are exact
    and only changed rows take part in the second step. There a key's sides are added up
    in every task first, and the rows of a key with very many changes are dealt over many
    tasks when they learn them.
    """
    columns = old.columns
    both = old.withColumn("_n", F.lit(-1)).unionByName(new.withColumn("_n", F.lit(1)))
    # So many parts that a task holds about as many rows at every size; a given number is not put together again.
    spark = old.sparkSession
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    parts = max(least, -(-both.count() // part_rows))
    changed = both.repartition(parts, *[F.col(f"`{c}`") for c in columns]).groupBy(*columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    keyed = changed.withColumn("_key", F.struct(*[F.col(f"`{k}`") for k in keys]))  # never NULL, whatever the keys are
    sides = keyed.groupBy("_key").agg(F.min("_n").alias("_least"), F.max("_n").alias("_most"))
    marked = left_join_split(keyed, sides, "_key", hot_rows, parts=parts)
    removed = F.col("_n") < 0
    in_both = (F.col("_least") < 0) & (F.col("_most") > 0)
    kind = (
        F.when(in_both & removed, "update_preimage")
        .when(in_both, "update_postimage")
        .when(removed, "delete")
        .otherwise("insert")
    )
    # A row that differs by several copies is listed once per copy.
    copies = F.explode(F.sequence(F.lit(1), F.abs("_n").cast("int")))
    return marked.select(*columns, kind.alias("change_type"), copies.alias("_copy")).drop("_copy")


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replay a snapshot difference on a snapshot with unique keys."""
    gone = changes.where(F.col("change_type").isin("delete", "update_preimage"))
    came = changes.where(F.col("change_type").isin("insert", "update_postimage"))
    touched = gone.select(*keys).distinct().alias("s")
    kept = old.alias("t").join(touched, _same_keys(keys, True), "left_anti")
    return kept.unionByName(came.drop("change_type"))
