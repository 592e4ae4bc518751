"""Table commit logs: one JSON action per line, one file per commit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.sources.listing import present

LOG_FOLDER = "_delta_log"
# The parts of the log actions that audits look at.
ACTION_LAYOUT = (
    "commitInfo struct<timestamp:bigint,operation:string,operationParameters:map<string,string>,"
    "userMetadata:string,engineInfo:string>, "
    "protocol struct<minReaderVersion:int,minWriterVersion:int>, "
    "metaData struct<schemaString:string,partitionColumns:array<string>,"
    "clusteringColumns:array<string>,configuration:map<string,string>>, "
    "add struct<path:string,size:bigint>, remove struct<path:string>"
)
SCHEMA_LAYOUT = "fields array<struct<name:string,type:string,nullable:boolean>>"
_SCALAR = r"^\s*(?:true|false|null|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)\s*$"


def commit_version(file_name: Column) -> Column:
    """Version of a commit file; NULL for every name that is not digits + ``.json``."""
    digits = F.regexp_extract(file_name, r"^(\d+)\.json$", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def scan_log_lines(spark: SparkSession, table_paths: Sequence[str]) -> DataFrame:
    """``(table_id, file_name, value)`` of the commit files of many tables.

    A path may be a glob over table folders. The id of a table is its folder, in the
    form that ``workspace.canonical`` gives.
    """
    folders = [f"{p.rstrip('/')}/{LOG_FOLDER}" for p in table_paths]
    there = present(spark, folders, "*.json")
    if not there:
        return spark.createDataFrame([], "table_id string, file_name string, value string")
    lines = spark.read.text([f"{f}/*.json" for f in folders if f in there])
    folder = F.regexp_replace("_metadata.file_path", rf"/{LOG_FOLDER}/[^/]+$", "")
    return lines.select(
        F.regexp_replace(folder, "^file:/+", "/").alias("table_id"),
        F.col("_metadata.file_name").alias("file_name"),
        "value",
    )


def parse_actions(lines: DataFrame, keys: Sequence[str] = ("table_id",)) -> DataFrame:
    """Typed actions of log lines; every line is parsed once.

    Lines that are not JSON give no action. Lines that are JSON but not an object
    are marked ``unreadable``, because a log with such lines cannot be trusted.
    """
    numbered = lines.withColumn("version", commit_version(F.col("file_name")))
    parsed = numbered.where(F.col("version").isNotNull()).select(
        *keys,
        "file_name",
        "version",
        F.from_json("value", ACTION_LAYOUT).alias("action"),
        F.coalesce(F.col("value").rlike(_SCALAR), F.lit(False)).alias("unreadable"),
    )
    return parsed.select(*keys, "file_name", "version", "unreadable", "action.*")


def schema_fields(schema_string: Column) -> Column:
    """Array of ``(name, type, nullable)`` of a serialised table schema."""
    return F.from_json(schema_string, SCHEMA_LAYOUT)["fields"]


def schema_names(schema_string: Column) -> Column:
    """Column names of a serialised table schema; NULL when it cannot be read."""
    return schema_fields(schema_string)["name"]


def scan_commit_log(spark: SparkSession, table_paths: Sequence[str]) -> DataFrame:
    """Typed actions of the commit files of many tables."""
    return parse_actions(scan_log_lines(spark, table_paths))
