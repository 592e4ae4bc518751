"""Silver, quarantine and gold tables on any Spark file format.

Layout: ``<base>/<tier>/<table>/v=<number>``. Each overwrite, upsert or compaction
writes a new version folder, and Spark's own ``_SUCCESS`` marker is what makes that
version the current one, so readers never see half of a table and a failed job
leaves the previous version in place. An append is a part of its own, ``v=<number>+<part>``,
with a marker of its own, and readers take a version with all of its complete parts; only in a
store with catalog names it adds files to the folder that the name points to. A table has
one writer at a time: a second one fails on the folder that is already there.

A gold table that is upserted lies in key buckets. An upsert writes the buckets that it
changes as a part too, and readers take every bucket from the newest complete part that
has it; so an upsert is seen whole or not at all.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.fixed_values import CLUSTER_KEYS
from clinlake.functions.joins import row_hash
from clinlake.functions.lookup import BROADCAST_BYTES, row_bytes, text_bytes
from clinlake.operators.merge import dedup_keys, source_is_small, upsert
from clinlake.sinks import buckets as linear
from clinlake.workspace import child_names, drop_tree, glob_paths, modified_at, path_exists

SUCCESS = "_SUCCESS"
APPEND = "APPEND"
NOT_FOUND = "NOT_FOUND"
AVAILABLE = "AVAILABLE"
UNAVAILABLE = "TELEMETRY_UNAVAILABLE"
COMMIT_LAYOUT = (
    "tier string, table_name string, version int, operation string, committed_at timestamp, "
    "clustering_columns array<string>, user_metadata string"
)

_COMMIT_FACTS = ("committed_at", "version", "operation", "user_metadata")
TELEMETRY_LAYOUT = (
    "status string, table_path string, format string, num_files bigint, bytes bigint, "
    "clustering_columns array<string>, recent_commits array<struct<committed_at:timestamp,"
    "version:int,operation:string,user_metadata:string>>, notice string"
)

# Size that a range partition, and so a clustered file, is meant to have.
PARTITION_BYTES = 256 * 1024 * 1024


def partitions_for(size: int) -> int:
    """Range partitions for data of a known size in bytes."""
    return max(1, -(-size // PARTITION_BYTES))


# Ranks that a clustering column's values are cut into, as a power of two.
RANK_BITS = 6


def _as_number(df: DataFrame, column: str) -> Column | None:
    """A number in the order of a column's values; None for types without one."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.StringType):  # its first six bytes
        return F.conv(F.hex(F.substring(F.rpad(value.cast("binary"), 6, b"\x00"), 1, 6)), 16, 10).cast("double")
    return None


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> Column | None:
    """Place of a row on a curve through the ranks of several columns, so that neighbours on it are near in every column.

    A column's ranks are cut at approximate quantiles, found in one pass over the columns;
    the digits of the ranks take turns in the place. NULL comes first.
    """
    numbers = [_as_number(df, c) for c in columns]
    if len(columns) < 2 or any(n is None for n in numbers):
        return None
    named = df.select(*[n.alias(f"c{i}") for i, n in enumerate(numbers)])
    steps = [i / 2**bits for i in range(1, 2**bits)]
    cuts = named.approxQuantile(named.columns, steps, 0.25 / 2**bits)
    place = F.lit(0).cast("bigint")
    for i, (number, own) in enumerate(zip(numbers, cuts, strict=True)):
        edges = sorted(set(own))
        rank = F.size(F.filter(F.lit(edges or [0.0]), lambda edge: edge < number))  # noqa: B023
        rank = F.when(number.isNull(), 0).otherwise(rank)
        for bit in range(bits):
            digit = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            place = place + F.shiftleft(digit, bit * len(columns) + len(columns) - 1 - i)
    return place


def cluster_rows(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the clustering columns, so that files hold narrow ranges of each of them.

    Several columns are put on one curve, so that a filter on any of them meets few files.
    A hash of the row is the last range key: a clustering key that fills a third of
    the table is cut into several ranges instead of ending in one task. Without a
    number of partitions the session's ``spark.sql.shuffle.partitions`` decides.
    """
    place = curve_place(df, columns)
    placed = df if place is None else df.withColumn("_place", place)
    keys = [F.col(c) for c in columns] if place is None else [F.col("_place"), *[F.col(c) for c in columns]]
    keys.append(row_hash(df))
    ranged = (
        placed.repartitionByRange(*keys) if partitions is None
        else placed.repartitionByRange(partitions, *keys)
    )
    return ranged.sortWithinPartitions(*(columns if place is None else ["_place", *columns])).select(df.columns)


def _known_mode(mode: str) -> str:
    """One of Spark's save modes; any other word is an error rather than an overwrite."""
    known = {"overwrite": "overwrite", "append": "append", "ignore": "ignore"}
    known |= dict.fromkeys(("error", "errorifexists"), "error")
    if mode not in known:
        raise ValueError(f"mode is one of {', '.join(sorted(known))}, not {mode!r}")
    return known[mode]


def inferred_cluster_keys(df: DataFrame) -> list[str]:
    """Clustering columns of the gold table that the columns look like."""
    by_width = sorted(CLUSTER_KEYS.values(), key=len, reverse=True)
    for keys in by_width:
        if all(c in df.columns for c in keys):
            return list(keys)
    return []


def _part_number(path: str) -> int:
    """Which part of its version a folder is; the version itself comes first."""
    return int(path.rpartition("/v=")[2].partition("+")[2] or -1)


@dataclass
class Layout:
    """Key buckets of a table version: the partition column, all folders (oldest first) and the parts that they lie in."""

    column: str
    folders: list[str]
    parts: list[str]

    def __post_init__(self):
        self.keys = linear.keys_of(self.column)
        self.live = linear.newest(self.folders)
        self.count = max(self.live) + 1

    def sql(self, fmt: str) -> str:
        """The table as a query over its folders, for a name in the catalog."""
        by_part: dict[str, list[str]] = {}
        for folder in self.live.values():
            part, _, bucket = folder.rpartition("/")
            by_part.setdefault(part, []).append(bucket.rsplit("=", 1)[1])
        return " UNION ALL ".join(
            f"SELECT * FROM {fmt}.`{part}/*={{{','.join(own)}}}`" for part, own in by_part.items()
        )

    def rows(self, spark: SparkSession, fmt: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of the given buckets, by default of all.

        A bucket all of whose keys have moved on is written nowhere any more; its old rows are left out here.
        """
        paths = [self.live[b] for b in sorted(self.live if buckets is None else buckets)]
        lies_in = F.regexp_extract("_metadata.file_path", r"=(\d+)/[^/]+$", 1).cast("int")
        return spark.read.format(fmt).load(paths).where(lies_in == linear.bucket_number(self.keys, self.count))


class TableStore:
    """Writes and maintains the tables under one base folder."""

    def __init__(
        self,
        spark: SparkSession,
        base_path: str,
        fmt: str = "parquet",
        catalog: str | None = None,
        schema: str | None = None,
    ):
        self.spark = spark
        self.base_path = base_path.rstrip("/")
        self.fmt = fmt
        self.namespace = f"{catalog}.{schema}" if catalog and schema else schema

    # -- paths and versions -------------------------------------------------

    def table_path(self, tier: str, table: str) -> str:
        return f"{self.base_path}/{tier.lower()}/{table.lower()}"

    def _numbers(self, tier: str, table: str) -> list[int]:
        """Numbers of all version folders, finished or not."""
        names = child_names(self.spark, self.table_path(tier, table))
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())

    def versions(self, tier: str, table: str) -> list[int]:
        """Complete versions, oldest first."""
        root = self.table_path(tier, table)
        return [
            n
            for n in self._numbers(tier, table)
            if path_exists(self.spark, f"{root}/v={n}/{SUCCESS}")
        ]

    def current_path(self, tier: str, table: str) -> str | None:
        complete = self.versions(tier, table)
        return f"{self.table_path(tier, table)}/v={complete[-1]}" if complete else None

    def _next_path(self, tier: str, table: str) -> tuple[int, str]:
        number = max(self._numbers(tier, table), default=-1) + 1
        return number, f"{self.table_path(tier, table)}/v={number}"

    def read(
        self, tier: str, table: str, version: int | None = None, merge_schema: bool | None = None
    ) -> DataFrame:
        """Current (or a given) version; files of different schemas are read as one.

        Spark opens every file to merge schemas, so by default that is done only for
        versions that have been appended to.
        """
        path = f"{self.table_path(tier, table)}/v={version}"
        if version is None:
            path = self.current_path(tier, table)
        if path is None or not path_exists(self.spark, path):
            raise FileNotFoundError(f"no table {tier}/{table} under {self.base_path}")
        number = int(path.rsplit("=", 1)[-1])
        laid = self._layout(tier, table, number)
        if laid is not None:
            return laid.rows(self.spark, self.fmt)
        paths = self._parts(tier, table, number)
        if merge_schema is None:
            appended = (F.col("version") == number) & (F.col("operation") == APPEND)
            merge_schema = len(paths) > 1 or bool(self.namespace) and not self._history(tier, table).where(appended).isEmpty()
        reader = self.spark.read.format(self.fmt)
        if self.fmt in ("parquet", "orc"):
            reader = reader.option("mergeSchema", merge_schema)
        return reader.load(paths)

    def _parts(self, tier: str, table: str, version: int) -> list[str]:
        """The folder of a version and those of its complete parts, oldest first."""
        base = f"{self.table_path(tier, table)}/v={version}"
        complete = [p.removesuffix(f"/{SUCCESS}") for p in glob_paths(self.spark, f"{base}+*/{SUCCESS}")]
        return [base, *sorted(complete, key=_part_number)]

    def data_paths(self, tier: str, table: str) -> list[str]:
        """All folders of the current version; empty without one."""
        complete = self.versions(tier, table)
        return self._parts(tier, table, complete[-1]) if complete else []

    def _next_part(self, path: str) -> str:
        return f"{path}+{max(map(_part_number, glob_paths(self.spark, path + '+*')), default=-1) + 1}"

    def _layout(self, tier: str, table: str, version: int) -> Layout | None:
        """The buckets of a version that is laid out by keys; None for any other."""
        base = f"{self.table_path(tier, table)}/v={version}"

        def inside(name: str) -> list[str]:
            return glob_paths(self.spark, f"{base}/{name}") + glob_paths(self.spark, f"{base}+*/{name}")

        complete = sorted((p.removesuffix(f"/{SUCCESS}") for p in inside(SUCCESS)), key=_part_number)  # full paths
        folders = [f for f in inside(f"{linear.PREFIX}*=*") if f.rpartition("/")[0] in complete]
        if not folders:
            return None
        order = {p: n for n, p in enumerate(complete)}
        folders.sort(key=lambda f: order[f.rpartition("/")[0]])
        return Layout(unquote(folders[0].rpartition("/")[2].rpartition("=")[0]), folders, complete)

    def _history(self, tier: str, table: str) -> DataFrame:
        """Commits of one table."""
        mine = (F.col("tier") == tier) & (F.col("table_name") == table.lower())
        return self.commits().where(mine)

    # -- writes -------------------------------------------------------------

    def _register(self, name: str, tier: str, table: str) -> None:
        """Point the catalog name at the current version, with all of its columns."""
        if self.namespace:
            full, path = f"{self.namespace}.{name}", self.current_path(tier, table)
            rows, laid = self.read(tier, table), self._layout(tier, table, self.versions(tier, table)[-1])
            known = self.spark.catalog.getTable(full).tableType if self.spark.catalog.tableExists(full) else None
            if known == "EXTERNAL" and laid is None and self.spark.table(full).schema == rows.schema:
                # The name stays readable while it is pointed elsewhere.
                self.spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
                self.spark.catalog.refreshTable(full)
                return
            if known is not None and not (known == "VIEW" and laid is not None):
                self.spark.sql(f"DROP {'VIEW' if known == 'VIEW' else 'TABLE'} {full}")
            if laid is not None:
                self.spark.sql(f"CREATE OR REPLACE VIEW {full} AS {laid.sql(self.fmt)}")
            else:
                self.spark.catalog.createTable(full, path, source=self.fmt, schema=rows.schema)

    def _log(
        self, tier: str, table: str, version: int, operation: str,
        clustering: Sequence[str] = (), user_metadata: str | None = None,
    ) -> None:
        entry = self.spark.range(0, 1, 1, 1).select(
            F.lit(tier).alias("tier"), F.lit(table.lower()).alias("table_name"), F.lit(version).alias("version"),
            F.lit(operation).alias("operation"), F.array(*map(F.lit, clustering)).cast("array<string>").alias("clustering_columns"),
            F.lit(user_metadata).cast("string").alias("user_metadata"), F.current_timestamp().alias("committed_at"),
        )
        entry.write.mode("append").parquet(f"{self.base_path}/commits")

    def commits(self) -> DataFrame:
        """All commits of this store."""
        path = f"{self.base_path}/commits"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], COMMIT_LAYOUT)
        return self.spark.read.schema(COMMIT_LAYOUT).parquet(path)

    def _write_version(
        self, df: DataFrame, tier: str, table: str, operation: str, registered_as: str,
        clustering: Sequence[str] = (), user_metadata: str | None = None,
    ) -> str:
        version, path = self._next_path(tier, table)
        df.write.format(self.fmt).mode("error").save(path)
        self._log(tier, table, version, operation, clustering, user_metadata)
        self._register(registered_as, tier, table)
        return path

    def _write(
        self, df: DataFrame, tier: str, table: str, registered_as: str, mode: str, merge_schema: bool = True,
        clustering: Sequence[str] = (), user_metadata: str | None = None,
    ) -> str:
        """Write in a save mode; a table that is there is left alone by ``ignore`` and refused by ``error``."""
        mode = _known_mode(mode)
        if mode == "append":
            return self._append(df, tier, table, registered_as, merge_schema)
        current = self.current_path(tier, table) if mode in ("ignore", "error") else None
        if current is not None and mode == "ignore":
            return current
        if current is not None:
            raise FileExistsError(f"table {tier}/{table} under {self.base_path} has a version already")
        return self._write_version(
            df, tier, table, "OVERWRITE", registered_as, clustering, user_metadata
        )

    def _append(
        self, df: DataFrame, tier: str, table: str, registered_as: str, merge_schema: bool
    ) -> str:
        path = self.current_path(tier, table)
        if path is None:
            return self._write_version(df, tier, table, APPEND, registered_as)
        if self._layout(tier, table, self.versions(tier, table)[-1]) is not None:
            raise ValueError(f"{tier}/{table} lies in key buckets: upsert into it")
        if not merge_schema:
            added = set(df.columns) - set(self.read(tier, table).columns)
            if added:
                raise ValueError(f"new columns: {sorted(added)}")
        # The folder that a catalog name points to has to hold all files.
        df.write.format(self.fmt).mode("append").save(path if self.namespace else self._next_part(path))
        self._log(tier, table, self.versions(tier, table)[-1], APPEND)
        self._register(registered_as, tier, table)
        return path

    def write_silver(
        self, df: DataFrame, table: str, mode: str = "overwrite", merge_schema: bool = True
    ) -> str:
        """Silver table; a new version, or more files in the current one (``append``)."""
        return self._write(df, "silver", table, f"silver_{table}", mode, merge_schema)

    def write_quarantine(
        self, df: DataFrame, table: str = "quarantine_records", mode: str = "append"
    ) -> str:
        """Rejected rows; appended by default, whatever columns they have."""
        return self._write(df, "silver", table, table, mode)

    def write_gold(
        self,
        df: DataFrame,
        table: str,
        cluster_by: Sequence[str] | None = None,
        mode: str = "overwrite",
        merge_schema: bool = True,
        user_metadata: str | None = None,
        partitions: int | None = None,
    ) -> str:
        """Gold table, clustered by the given or the inferred columns."""
        keys = inferred_cluster_keys(df) if cluster_by is None else list(cluster_by)
        shaped = cluster_rows(df, keys, partitions) if keys else df
        return self._write(shaped, "gold", table, table, mode, merge_schema, keys, user_metadata)

    def upsert_gold(
        self,
        df: DataFrame,
        table: str,
        keys: Sequence[str],
        cluster_by: Sequence[str] | None = None,
        latest_by: Sequence[str] = (),
        merge_schema: bool = False,
        user_metadata: str | None = None,
        partitions: int | None = None,
    ) -> str:
        """Upsert into the current version; the first load is de-duplicated as well."""
        clustering = inferred_cluster_keys(df) if cluster_by is None else list(cluster_by)
        current = self.current_path("gold", table)
        if current is None:
            merged = dedup_keys(df, keys, latest_by)
        else:
            partitions = partitions or partitions_for(self.size_of(self.data_paths("gold", table)))
            merged = upsert(
                self.read("gold", table), df, keys, latest_by,
                small_source=source_is_small(df, keys) or None, merge_schema=merge_schema,
            )
        shaped = cluster_rows(merged, clustering, partitions) if clustering else merged
        return self._write_version(
            shaped, "gold", table, "UPSERT", table, clustering, user_metadata
        )

    def upsert_touched(
        self,
        df: DataFrame,
        table: str,
        keys: Sequence[str],
        latest_by: Sequence[str] = (),
        buckets: int | None = None,
        bucket_bytes: int = PARTITION_BYTES,
        relay: bool = False,
        user_metadata: str | None = None,
    ) -> list[int]:
        """Upsert into a gold table laid out by key buckets; only buckets with a key of ``df`` or due to split are rewritten.

        The first load lays the table out. Later ones let it grow by linear hashing, a
        bucket for every ``bucket_bytes`` that the table and ``df`` have together, so at most
        one bucket more than those with keys of ``df`` is rewritten for every bucket that is
        new. Files of all other buckets stay. Returns the buckets written. NULL keys match
        each other. A table in another layout is refused, or with ``relay`` laid out anew.
        """
        current = self.current_path("gold", table)
        version = -1 if current is None else int(current.rsplit("=", 1)[-1])
        laid = None if current is None else self._layout("gold", table, version)
        column = linear.bucket_column(keys)
        if current is not None and (laid is None or laid.column != column) and not relay:
            raise ValueError(f"gold/{table} is not laid out by buckets of {list(keys)}")
        if laid is None or laid.column != column:
            if df.isEmpty():
                return []
            merged = dedup_keys(df, keys, latest_by)
            if current is not None:
                merged = upsert(self.read("gold", table), df, keys, latest_by)
            grown = buckets or max(1, -(-(text_bytes(df) + self.size_of(self.data_paths("gold", table))) // bucket_bytes))
            written, replaced = list(range(grown)), []
            version, path = self._next_path("gold", table)
        else:
            n = laid.count
            stored = laid.rows(self.spark, self.fmt)
            source = df.withColumns({k: F.col(f"`{k}`").cast(stored.schema[k].dataType) for k in keys})
            facts = source.groupBy(linear.bucket_number(keys, n).alias("b")).agg(F.sum(row_bytes(source)).alias("bytes"))
            touched = {r["b"]: r["bytes"] for r in facts.collect()}
            if not touched:
                return []
            added = sum(touched.values())
            grown = max(n, -(-(self.size_of(list(laid.live.values())) + added) // bucket_bytes))
            rewritten = touched.keys() | linear.splitting(n, grown)
            written = sorted(rewritten) + list(range(n, grown))
            replaced = [laid.live[b] for b in sorted(rewritten & laid.live.keys())]
            old = laid.rows(self.spark, self.fmt, rewritten & laid.live.keys()) if replaced else stored.where("false")
            merged = upsert(old, source, keys, latest_by, small_source=added <= BROADCAST_BYTES or source_is_small(source, keys) or None)
            path = self._next_part(current)
        clustering = inferred_cluster_keys(df)
        numbered = merged.withColumn(column, linear.bucket_number(keys, grown))
        places = self.spark.range(0, 1, 1, 1).select(F.posexplode(F.lit(written)).alias("_place", column))
        dealt = numbered.join(F.broadcast(places), column).repartitionById(len(written), "_place").drop("_place")
        shaped = dealt.sortWithinPartitions(column, *clustering)
        shaped.write.format(self.fmt).mode("error").partitionBy(column).save(path)
        self._log("gold", table, version, "UPSERT", clustering, user_metadata)
        self._clear(self._layout("gold", table, version), replaced)
        self._register(table, "gold", table)
        return sorted(b for b in written if glob_paths(self.spark, f"{path}/*={b}"))

    def _clear(self, laid: Layout, replaced: Iterable[str]) -> None:
        """Delete folders whose buckets have been written anew, and parts that are left with none."""
        live = set(laid.live.values()) - set(replaced)
        for folder in laid.folders:
            if folder not in live:
                drop_tree(self.spark, folder)
        in_use = {f.rsplit("/", 1)[0] for f in live}
        for part in laid.parts[1:]:
            if part not in in_use:
                drop_tree(self.spark, part)

    def size_of(self, *paths: str | list[str] | None) -> int:
        """Bytes of the data files under the given paths."""
        return sum(file_stats(self.spark, p).first()["bytes"] for p in paths if p)

    # -- maintenance --------------------------------------------------------

    def compact(
        self, tier: str, table: str, cluster_by: Sequence[str] = (), files: int | None = None
    ) -> DataFrame:
        """Rewrite the current version into fewer files, clustered if columns are named.

        Returns file counts and bytes before and after. Without ``files`` the runtime
        picks the file sizes (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
        """
        before_path = self.current_path(tier, table)
        if before_path is None:
            raise FileNotFoundError(f"no table {tier}/{table} under {self.base_path}")
        rows, before_path = self.read(tier, table), self.data_paths(tier, table)
        if cluster_by:
            parts = files or partitions_for(self.size_of(before_path))
            rows = cluster_rows(rows, cluster_by, parts)
        else:
            rows = rows.coalesce(files) if files else rows.hint("rebalance")
        named_silver = tier.lower() == "silver" and not table.startswith("quarantine")
        name = f"silver_{table}" if named_silver else table
        after_path = self._write_version(rows, tier, table, "COMPACT", name, cluster_by)
        before = file_stats(self.spark, before_path).withColumn("status", F.lit("before"))
        after = file_stats(self.spark, after_path).withColumn("status", F.lit("after"))
        return before.unionByName(after)

    def prune_versions(
        self, tier: str, table: str, keep: int = 2, older_than_hours: float = 168.0
    ) -> list[int]:
        """Delete superseded versions; the newest ``keep`` and recent ones stay."""
        root = self.table_path(tier, table)
        limit = (time.time() - older_than_hours * 3600.0) * 1000.0
        old = self.versions(tier, table)[: -max(keep, 1)]
        stale = [n for n in old if modified_at(self.spark, f"{root}/v={n}/{SUCCESS}") <= limit]
        for n in stale:
            for part in glob_paths(self.spark, f"{root}/v={n}+*"):
                drop_tree(self.spark, part)
        return [n for n in stale if drop_tree(self.spark, f"{root}/v={n}")]

    def telemetry(self, tier: str, table: str, commits: int = 5) -> DataFrame:
        """One row: state, file count, bytes, clustering columns, last commits.

        The state is ``NOT_FOUND`` without a complete version, and
        ``TELEMETRY_UNAVAILABLE`` (with a notice) when its facts cannot be read.
        """
        path = self.current_path(tier, table)
        facts = {
            "status": NOT_FOUND, "table_path": path or self.table_path(tier, table),
            "format": self.fmt, "recent_commits": [],
        }
        if path is not None:
            newest = self._history(tier, table).orderBy(F.desc("committed_at"), F.desc("version"))
            try:
                history = newest.limit(commits).collect()
                facts |= file_stats(self.spark, self.data_paths(tier, table)).first().asDict()
                facts |= {
                    "status": AVAILABLE,
                    "clustering_columns": history[0]["clustering_columns"],
                    "recent_commits": [{k: c[k] for k in _COMMIT_FACTS} for c in history],
                }
            except (PySparkException, IndexError) as error:
                facts |= {"status": UNAVAILABLE, "notice": str(error)}
        return self.spark.createDataFrame([facts], TELEMETRY_LAYOUT)


def file_stats(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Number and bytes of a table's data files, from the listing; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .load(path)
    )
    return files.agg(
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )


#: Reports in one file: a gzip file is read by one task.
REPORTS_A_FILE = 200_000


def write_reports(reports: DataFrame, path: str, date_column: str = "audit_date") -> None:
    """Append report documents (``report_json``) as JSON lines in gzip files, by audit date.

    Reports say nearly the same, so packed they take a small part of their length.
    """
    dated = reports.withColumn(date_column, F.to_date("audit_timestamp"))
    lines = dated.select(date_column, F.col("report_json").alias("value")).write.mode("append").partitionBy(date_column)
    lines.options(compression="gzip", maxRecordsPerFile=REPORTS_A_FILE).text(path)
