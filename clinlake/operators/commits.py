"""Roll-ups of commit-log actions: per commit, per table, and the newest commits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinlake.operators.sequence import LEVEL_BITS

UNKNOWN_OPERATION = "UNKNOWN"
KEYS = ("table_id",)


def _last(struct: str, order: Column) -> Column:
    """The struct of the group's action of that kind; the greatest order wins."""
    return F.max_by(struct, F.when(F.col(struct).isNotNull(), order))


def _flag(name: str) -> Column:
    setting = F.col("metaData.configuration")[name] == "true"
    return F.coalesce(F.bool_or(setting), F.lit(False))


def commit_rollup(actions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per commit: action counts and commit metadata."""
    grouped = actions.groupBy(*keys, "version", "file_name").agg(
        F.count("add").alias("add_actions"),
        F.count("remove").alias("remove_actions"),
        F.count_if("unreadable").alias("unreadable_lines"),
        _last("commitInfo", F.coalesce("commitInfo.timestamp", F.lit(-1))).alias("info"),
        _last("metaData", F.coalesce("metaData.schemaString", F.lit(""))).alias("meta"),
        _last("protocol", F.coalesce("protocol.minWriterVersion", F.lit(-1))).alias("protocol"),
        _flag("delta.enableChangeDataFeed").alias("change_feed"),
        _flag("delta.enableDeletionVectors").alias("deletion_vectors"),
    )
    return grouped.select(
        *keys,
        "version",
        "file_name",
        F.col("info.timestamp").alias("commit_ts"),
        F.coalesce("info.operation", F.lit(UNKNOWN_OPERATION)).alias("operation"),
        F.col("info.operationParameters").alias("operation_parameters"),
        F.col("info.engineInfo").alias("engine_info"),
        F.col("info.userMetadata").alias("user_metadata"),
        "add_actions",
        "remove_actions",
        "unreadable_lines",
        F.col("meta.schemaString").alias("schema_string"),
        F.coalesce("meta.clusteringColumns", "meta.partitionColumns").alias("clustering_columns"),
        F.col("meta.partitionColumns").alias("partition_columns"),
        "protocol",
        "change_feed",
        "deletion_vectors",
    )


def _latest(column: str, order: str = "version") -> Column:
    known = F.when(F.col(column).isNotNull(), F.col(order))
    return F.max_by(column, known).alias(column)


_ADDED_UP = (
    "total_commits", "total_add_actions", "total_remove_actions", "unreadable_lines",
    "commits_without_operation", "repeated_versions", "time_setbacks",
)


def _fold(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge the parts of each group, which are in ascending order of ``place``.

    A part that begins earlier than the last known time before it is a setback.
    """
    ordered = W.partitionBy(*keys, "grp").orderBy("place", "tie")
    known_before = F.last("last_ts", ignorenulls=True).over(
        ordered.rowsBetween(W.unboundedPreceding, -1)
    )
    set_back = F.coalesce((F.col("first_ts") < known_before).cast("bigint"), F.lit(0))
    checked = parts.withColumn("time_setbacks", F.col("time_setbacks") + set_back)
    has_time = F.when(F.col("first_ts").isNotNull(), F.struct("place", "tie"))
    return checked.groupBy(*keys, "grp").agg(
        *[F.sum(c).alias(c) for c in _ADDED_UP],
        F.min("first_version").alias("first_version"),
        F.max("last_version").alias("last_version"),
        F.min_by("first_ts", has_time).alias("first_ts"),
        F.max_by("last_ts", has_time).alias("last_ts"),
        F.bool_or("change_feed").alias("change_feed"),
        F.bool_or("deletion_vectors").alias("deletion_vectors"),
        *[_latest(c, "place") for c in ("protocol", "schema_string", "clustering_columns")],
    )


def table_rollup(commits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per table: totals, latest metadata, sequence and time checks.

    Commits are merged in the order of their versions, first within segments of 2**21
    versions, then segments, then blocks of segments. So the log of one very busy
    table is worked on by many tasks, and every commit is read once.
    """
    no_operation = F.coalesce("operation", F.lit(UNKNOWN_OPERATION)) == UNKNOWN_OPERATION
    in_order = W.partitionBy(*keys, "grp").orderBy("place", "tie")
    same_place = F.lag("place").over(in_order) == F.col("place")
    repeated = F.coalesce(same_place.cast("bigint"), F.lit(0))
    level = commits.withColumn("grp", F.shiftright("version", LEVEL_BITS)).select(
        *keys,
        "grp",
        F.col("version").alias("place"),
        F.col("file_name").alias("tie"),
        F.lit(1).cast("bigint").alias("total_commits"),
        F.col("add_actions").alias("total_add_actions"),
        F.col("remove_actions").alias("total_remove_actions"),
        "unreadable_lines",
        no_operation.cast("bigint").alias("commits_without_operation"),
        F.lit(0).cast("bigint").alias("time_setbacks"),
        F.col("version").alias("first_version"),
        F.col("version").alias("last_version"),
        F.col("commit_ts").alias("first_ts"),
        F.col("commit_ts").alias("last_ts"),
        "change_feed",
        "deletion_vectors",
        "protocol",
        "schema_string",
        "clustering_columns",
    )
    segments = _fold(level.withColumn("repeated_versions", repeated), keys)
    blocks = _fold(_raise(segments, F.shiftright("place", LEVEL_BITS)), keys)
    tables = _fold(_raise(blocks, F.lit(0)), keys)
    span = F.col("last_version") - F.col("first_version") + 1
    whole = (F.col("repeated_versions") == 0) & (F.col("total_commits") == span)
    return tables.drop("grp").withColumns(
        {"is_continuous": whole, "is_monotonic": F.col("time_setbacks") == 0}
    )


def _raise(parts: DataFrame, group: Column) -> DataFrame:
    """Groups of one level become the parts of the next."""
    moved = parts.withColumnsRenamed({"grp": "place"}).withColumn("tie", F.lit(""))
    return moved.withColumn("grp", group.cast("bigint"))


#: Versions that are counted together, and then ranked together, where many commits of a table are asked for.
SEGMENT_BITS = 12
#: Up to here Spark keeps only the newest rows per table in every task, before the shuffle.
FEW = 1000


def commit_tail(
    commits: DataFrame, limit: int = 10, keys: Sequence[str] = KEYS, few: int = FEW, segment_bits: int = SEGMENT_BITS
) -> DataFrame:
    """The newest ``limit`` commits of every table, with their ``position``.

    For fewer than ``few`` each task keeps at most ``limit`` commits per table before the
    shuffle. For more, commits are counted by segments of versions first: the counts tell
    in which segment the last one wanted lies and at which position a segment begins, so
    only wanted segments are ranked, each by itself, and no task sees a whole log.
    """
    newest_first = [F.desc("version"), F.desc("file_name")]
    if limit < few:
        ranked = commits.withColumn("position", F.row_number().over(W.partitionBy(*keys).orderBy(*newest_first)))
        return ranked.where(F.col("position") <= limit)
    segment = F.shiftright("version", segment_bits)
    counts = commits.groupBy(*keys, segment.alias("_segment")).agg(F.count(F.lit(1)).alias("_n"))
    newer = W.partitionBy(*keys).orderBy(F.desc("_segment")).rowsBetween(W.unboundedPreceding, -1)
    begin = counts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_segment").alias("_s"),
        F.coalesce(F.sum("_n").over(newer), F.lit(0)).alias("_before"),
    ).where(F.col("_before") < limit)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    wanted = commits.withColumn("_segment", segment).join(begin, same & (F.col("_segment") == F.col("_s")))
    inside = W.partitionBy(*keys, "_segment").orderBy(*newest_first)
    ranked = wanted.withColumn("position", (F.row_number().over(inside) + F.col("_before")).cast("int"))
    return ranked.where(F.col("position") <= limit).select(*commits.columns, "position")


def tail_summary(commits: DataFrame, limit: int = 10, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per table: commits in all, commits in the tail, action counts and latest metadata."""
    tail = commit_tail(commits, limit, keys)
    in_tail = tail.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("inspected_commits"),
        F.sum("add_actions").alias("added_files"),
        F.sum("remove_actions").alias("removed_files"),
        _latest("schema_string"),
        _latest("partition_columns"),
    )
    total = commits.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_commits"))
    return total.join(in_tail, list(keys))
