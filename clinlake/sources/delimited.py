"""File scans: untyped CSV, several formats by extension, fallback paths."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.fixed_values import SYNTHEA_COLUMNS
from clinlake.functions.lookup import BROADCAST_BYTES, size_at_most
from clinlake.operators.columns import rename_known
from clinlake.sources import listing
from clinlake.workspace import path_exists, scratch_path

# What the silver parsers and the OMOP transforms read of each source.
NEEDED_COLUMNS = {
    "patients": ("raw_patient_id", "gender", "birth_datetime", "race", "ethnicity"),
    "diagnoses": ("encounter_id", "raw_patient_id", "diagnosis_date", "icd10_code", "diagnosis_description"),
    "labs": (
        "lab_event_id", "raw_patient_id", "lab_datetime", "loinc_code", "test_name", "numeric_value", "unit_value",
    ),
}


def stamp_ingest(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Append ``ingestion_timestamp``; a given moment makes reruns reproducible."""
    moment = F.current_timestamp() if as_of is None else F.to_timestamp(F.lit(as_of.isoformat()))
    return df.withColumn("ingestion_timestamp", moment)


def scan_csv(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header, every column a string.

    With ``columns`` no job runs before the scan itself and a file whose header
    differs is refused; without, Spark takes the names from the header line.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        all_strings = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(all_strings).option("enforceSchema", False)
    return reader.csv(path)


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, value): the first line of every file.

    Tasks read the beginnings of the files. Where only Spark can open a path, it takes a pass
    over all lines, of which each task keeps one per file.
    """
    if all(listing.knows(r) for r in listing.roots(spark, path)):
        return listing.file_heads(spark, path, lambda lines: next(lines, None))
    first = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(path).select("value", listing.plain_path().alias("file"), first.alias("place"))
    return lines.groupBy("file").agg(F.min_by("value", "place").alias("value"))


def small_or_not(df: DataFrame) -> DataFrame:
    """A look-up table, broadcast if its bytes are few."""
    return F.broadcast(df) if size_at_most(df, BROADCAST_BYTES) else df


def scan_csv_by_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files with headers of their own, every column a string.

    However many headers there are, the lines are scanned and split once; each field goes
    to the column that its own file's header names. Columns that a file lacks are NULL for its rows.
    """
    kept = scratch_path(spark, "headers")
    file_headers(spark, path).write.parquet(kept)
    headers = spark.read.schema("file string, value string").parquet(kept)
    distinct = sorted(r["value"] for r in headers.select("value").distinct().collect())
    if len(distinct) <= 1:
        return scan_csv(spark, path)
    layouts = {header: next(csv.reader([header])) for header in distinct}
    names = list(dict.fromkeys(n for layout in layouts.values() for n in layout))
    # Per header: at which place of its lines each column is.
    places = spark.createDataFrame(
        [(h, [layout.index(n) if n in layout else None for n in names]) for h, layout in layouts.items()],
        "value string, places array<int>",
    )
    known = headers.join(F.broadcast(places), "value").select("file", F.col("value").alias("header"), "places")
    lines = spark.read.text(path).select("value", listing.plain_path().alias("file"))
    placed = lines.join(small_or_not(known), "file").where("value <> header and value <> ''")
    widest = max(map(len, layouts.values()))
    cells = F.from_csv("value", ", ".join(f"_{i} STRING" for i in range(widest)))
    split = placed.select("places", cells.alias("r")).select("places", F.array("r.*").alias("cells"))
    return split.select(*[F.get("cells", F.get("places", F.lit(i))).alias(n) for i, n in enumerate(names)])


def first_existing(spark: SparkSession, *paths: str) -> str:
    """First of several paths (or globs) that exists."""
    for path in paths:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these paths exists: {', '.join(paths)}")


def first_readable(
    spark: SparkSession, paths: Sequence[str], read: Callable[[str], DataFrame]
) -> DataFrame:
    """What ``read`` makes of the first path that exists and can be read.

    A read counts as failed when Spark refuses it while ``read`` looks at the files (their
    headers); errors of the reader itself, such as missing columns, are not passed over.
    """
    failed: Exception | None = None
    left = list(paths)
    while left:
        try:
            path = first_existing(spark, *left)
        except FileNotFoundError:
            if failed is not None:
                raise failed from None
            raise
        try:
            return read(path)
        except (PySparkException, Py4JJavaError) as error:
            failed, left = error, left[left.index(path) + 1 :]
    raise failed


def scan_source(
    spark: SparkSession,
    source: str,
    *paths: str,
    export: str = "canonical",
    as_of: datetime | None = None,
) -> DataFrame:
    """Bronze ``patients``, ``diagnoses`` or ``labs`` from the first path that can be read.

    Every file's own header names its columns. ``export="synthea"`` renames the columns of a
    Synthea CSV export; a canonical source has to have all columns that its transform needs.
    """
    if export not in ("synthea", "canonical"):
        raise ValueError(f"unknown export {export!r}")

    def read(path: str) -> DataFrame:
        rows = scan_csv_by_header(spark, path)
        if export == "synthea":
            return rename_known(rows, SYNTHEA_COLUMNS[source])
        missing = [c for c in NEEDED_COLUMNS[source] if c not in rows.columns]
        if missing:
            raise ValueError(f"{path} lacks columns of {source}: {missing}")
        return rows

    return stamp_ingest(first_readable(spark, paths, read), as_of)


def load_dataset(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer_types: bool = False,
    json_array: bool = False,
) -> DataFrame:
    """CSV, TSV, Parquet or JSON by file extension; other extensions read as CSV.

    Without a schema the columns of CSV and TSV are strings; ``infer_types`` asks for typed ones,
    which cost a pass over the data. JSON is one object
    per line, or with ``json_array`` one array of objects per file.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no such dataset: {path}")
    extension = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if extension == "parquet":
        return reader.parquet(path)
    if extension == "json":
        return reader.option("multiLine", json_array).json(path)
    reader = reader.option("header", True).option("sep", "\t" if extension == "tsv" else ",")
    if schema is None and infer_types:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)
