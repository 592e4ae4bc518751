"""SHA-256 manifests of files and of rows."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions.parsing import as_column
from clinlake.sources import listing

# Tasks get these functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 8 * 1024 * 1024
_MANIFEST = "path string, length bigint, sha256 string"
#: Files that ``write_each`` puts into one folder.
FOLDER_FILES = 1000


def _digests(block_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def digest(path: str) -> str:
            filesystem, own = listing.opened(path)
            state = hashlib.sha256()
            with filesystem.open_input_stream(own) as stream:
                while block := stream.read(block_bytes):
                    state.update(block)
            return state.hexdigest()

        for batch in batches:
            yield batch.assign(sha256=[digest(path) for path in batch["path"]])

    return run


def file_manifest(
    spark: SparkSession,
    path: str | Sequence[str],
    name_filter: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(path, length, sha256)`` of every file under the given paths, empty ones too.

    Files are listed, dealt and read inside tasks, block by block, so their sizes do not
    matter. A digest is sequential by nature: one task reads one file.
    """
    files = listing.dealt(listing.list_files(spark, path, name_filter), "path")
    return files.mapInPandas(_digests(block_bytes), _MANIFEST)


def write_each(df: DataFrame, path: str, name: str, value: str) -> list[str]:
    """Write the text of every row, and a line end, as a file of its own; the folders of the files.

    Rows are written by the tasks that read them, each into a folder of its own (so that the files of a
    lost attempt are not among those returned) with sub-folders of a thousand files. A file is named ``<name>-<n>.txt``,
    so rows with equal names or none (``null``) are files of their own too.
    """
    rows = df.select(F.col(name).cast("string").alias("name"), F.col(value).alias("value"))
    root = listing.roots(df.sparkSession, path)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, n = f"{root}/task-{TaskContext.get().taskAttemptId()}", 0
        filesystem, own = listing.opened(folder)
        for batch in batches:
            for row_name, text in zip(batch.column("name").to_pylist(), batch.column("value"), strict=True):
                if n % FOLDER_FILES == 0:
                    filesystem.create_dir(f"{own}/{n // FOLDER_FILES}", recursive=True)
                file = f"{own}/{n // FOLDER_FILES}/{'null' if row_name is None else row_name}-{n}.txt"
                with filesystem.open_output_stream(file) as stream:
                    stream.write((text.as_py() or "").encode("utf-8", "surrogatepass") + b"\n")
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([folder])], names=["folder"])

    return [r["folder"] for r in rows.mapInArrow(run, "folder string").collect()]


def text_digest(value: Column | str) -> Column:
    """SHA-256 of a string or binary value, as hex."""
    return F.sha2(as_column(value).cast("binary"), 256)


def row_digest(columns: Sequence[Column | str]) -> Column:
    """SHA-256 over several columns, with NULL and '' kept apart."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit("\0")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)
