"""What several operators of this folder share: text batches, bounded samples, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.workspace import scratch_path

#: Characters of text that a Python worker handles at once, so that long texts cannot add up.
SLICE_CHARS = 500_000

#: What separates words, and what a word is, for a Spark regular expression.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(spark: SparkSession, df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: a cut in the lineage that survives lost executors."""
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased words between the white space characters 0x20 and 0x09 to 0x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def map_stream(
    df: DataFrame, schema: str, stream: Callable[[Iterator[list[dict]]], Iterator[list[tuple]]], text: str = "text"
) -> DataFrame:
    """Run a Python generator over a task's rows, Arrow to Arrow.

    ``stream`` gets bounded lists of rows as dicts (their texts of about SLICE_CHARS
    characters together) and yields lists of tuples in the order of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    target = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(target, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part.to_pylist() for batch in batches for part in _slices(batch, text))
        for found in stream(parts):
            for at in range(0, len(found), 20_000):
                columns = list(zip(*found[at : at + 20_000], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    return df.mapInArrow(run, target)


def map_rows(
    df: DataFrame, schema: str, rows: Callable[[], Callable[[list[dict]], list[tuple]]], text: str = "text"
) -> DataFrame:
    """``map_stream`` for lists that do not depend on each other; ``rows`` is called once per task."""

    def stream(parts):
        work = rows()
        for part in parts:
            yield work(part)

    return map_stream(df, schema, stream, text)


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    held_in = batch.column(text) if text in batch.schema.names else None
    if held_in is None:
        lengths = []
    elif pa.types.is_binary(held_in.type) or pa.types.is_large_binary(held_in.type):
        lengths = pa.compute.binary_length(held_in).to_pylist()
    else:
        lengths = pa.compute.utf8_length(held_in).to_pylist()
    if not lengths:
        yield batch
        return
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and held + (n or 0) > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    yield batch.slice(start)


def smallest_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest hash of ``key``: a bounded sample that reruns alike."""
    return df.orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key)).limit(n)


def learnable(doc_id: str, folds: int, held: int):
    """True where crc32 of the id as text, modulo ``folds``, is not ``held``; NULL ids are not learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds != held


def held_out(doc_id: str, folds: int, held: int):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == held, F.lit(False))


def sql_crc32(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a string's UTF-8 bytes, bit by bit."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    fed = f"flatten(list_transform(range(0, CAST(octet_length(encode({text})) AS BIGINT)), lambda i: [{byte}, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce({fed}, {step}, 4294967295), 4294967295)"


def sql_lower(text: str) -> str:
    """DuckDB SQL for a text with only A-Z lower-cased; empty for NULL."""
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
