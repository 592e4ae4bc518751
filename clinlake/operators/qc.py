"""Status roll-up of quality-control reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_reports(spark: SparkSession, path: str) -> DataFrame:
    """Report lines with the name of the file they stand in."""
    lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_name").alias("report"), "value")


def status_rollup(lines: DataFrame, report: str = "report", line: str = "value") -> DataFrame:
    """Lines with PASS, WARN or FAIL per report; the first of them decides a line."""
    status = F.regexp_extract(line, "(PASS|WARN|FAIL)", 1)
    marked = lines.select(F.col(report), status.alias("status")).where(F.col("status") != "")
    return marked.groupBy(report, "status").agg(F.count(F.lit(1)).alias("lines"))
