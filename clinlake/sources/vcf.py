"""VCF text files as tables."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.operators.columns import cap_rows
from clinlake.sources import listing
from clinlake.sources.blockgzip import RANGE_BYTES, scan_block_gzip
from clinlake.sources.delimited import first_readable, small_or_not, stamp_ingest
from clinlake.workspace import scratch_path

# Tasks get these functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER_MARK = "#CHROM"
# Hadoop splits bzip2 by itself and block gzip is read in ranges; of other compressed files one task reads a whole one.
UNSPLITTABLE = (".gz", ".zst")


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of a VCF without its ``##`` remarks; the header line is kept."""
    lines = spark.read.text(path)
    return lines.where(~F.col("value").startswith("##"))


def header_columns(lines: DataFrame) -> DataFrame:
    """Column names of the header line, one row for each, with their position."""
    header = lines.where(F.col("value").startswith(HEADER_MARK)).limit(1)
    return header.select(
        F.posexplode(F.split("value", "\t")).alias("position", "label")
    ).select("position", F.lower(F.ltrim("label", F.lit("#"))).alias("column_name"))


def _header_line(lines: Iterator[str]) -> str | None:
    """The header line, if it comes before the first data line."""
    for line in lines:
        if not line.startswith("#") and line:
            return None
        if line.startswith(HEADER_MARK):
            return line
    return None


def find_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, fields): the column names of every file that has a header line.

    Tasks read the beginnings of the files, up to the header or the first data line. Where
    only Spark can open a path, it takes a pass over all lines.
    """
    if all(listing.knows(r) for r in listing.roots(spark, path)):
        headers = listing.file_heads(spark, path, _header_line)
    else:
        lines = spark.read.text(path).where(F.col("value").startswith(HEADER_MARK))
        headers = lines.groupBy(listing.plain_path().alias("file")).agg(F.min("value").alias("value"))
    label = F.transform(F.split("value", "\t"), lambda f: F.lower(F.ltrim(f, F.lit("#"))))
    return headers.select("file", label.alias("fields"))


def file_lines(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(value, path): all lines and their files; of gzip files by byte ranges where they are in blocks."""
    named = [path] if isinstance(path, str) else path
    if all(p.lower().endswith((".gz", ".bgz")) for p in named) and all(listing.knows(r) for r in listing.roots(spark, path)):
        return scan_block_gzip(spark, path, range_bytes).select("value", F.col("file").alias("path"))
    return spark.read.text(path).select("value", listing.plain_path().alias("path"))


def name_fields(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Data lines split at tabs, each field under the name that its own file's header gives it.

    Columns that a file lacks are NULL for its lines, and so are fields missing at the end
    of a short line. Where all headers are equal they also hold for files without one, such as
    the parts of one split file; otherwise a file with data but without header is an error.
    """
    kept = scratch_path(spark, "headers")
    find_headers(spark, path).write.parquet(kept)
    headers = spark.read.schema("file string, fields array<string>").parquet(kept)
    names = sorted(
        headers.select(F.posexplode("fields").alias("at", "name")).groupBy("name").agg(F.min("at")).collect(),
        key=lambda r: (r[1], r[0]),
    )
    if not names:
        raise ValueError("no #CHROM header line in the VCF")
    layouts = [r["fields"] for r in headers.select("fields").distinct().limit(2).collect()]
    lines = file_lines(spark, path, range_bytes)
    data = lines.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    named = data if len(layouts) == 1 else data.join(small_or_not(headers), F.col("path") == F.col("file"), "left")
    values = F.split("value", "\t")
    if len(layouts) == 1:
        places = F.array(*map(F.lit, layouts[0]))
    else:
        lost = F.raise_error(F.concat(F.lit("no #CHROM header line in "), "path"))
        places = F.when(F.col("fields").isNull(), lost).otherwise(F.col("fields"))
    return named.select(
        *[
            F.get(values, F.nullif(F.array_position(places, r["name"]), F.lit(0)).cast("int") - 1).alias(r["name"])
            for r in names
        ]
    )


def scan_vcf(
    spark: SparkSession,
    *paths: str,
    max_rows: int | None = None,
    as_of: datetime | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Variant rows of the first path that can be read, every field a string.

    Every file has its own header, and files with different ones are read as one table. A
    compressed file arrives as one partition, so its rows are spread again before any work
    is done on them.
    """

    def read(path: str) -> DataFrame:
        rows = name_fields(spark, path, range_bytes)
        if max_rows is not None:
            return cap_rows(rows, max_rows)
        return rows.hint("rebalance") if path.lower().endswith(UNSPLITTABLE) else rows

    return stamp_ingest(first_readable(spark, paths, read), as_of)
