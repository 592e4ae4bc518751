"""Row-wise operators on streams.

Parsing, the OMOP transforms and row violations take streaming frames as they are.
What needs state or two outputs runs per micro-batch here. Each batch goes into a
folder named by its id and replaces what an earlier attempt left there, so a
restarted query neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from clinlake.operators.silver import split_rows
from clinlake.sinks.tables import TableStore


def split_stream(
    stream: DataFrame,
    condition: Column,
    accepted_path: str,
    rejected_path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Write accepted rows (transformed) and rejected rows of a stream to two tables."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sides = split_rows(batch, condition)
        outputs = {accepted_path: transform(sides.accepted), rejected_path: sides.rejected}
        for path, frame in outputs.items():
            frame.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    stream: DataFrame,
    store: TableStore,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    latest_by: Sequence[str] = (),
) -> StreamingQuery:
    """Upsert every micro-batch into a gold table; applying a batch twice changes nothing.

    The table is laid out by key buckets, of which a batch rewrites those it touches.
    """

    def merge(batch: DataFrame, _: int) -> None:
        store.upsert_touched(batch, table, keys, latest_by)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
