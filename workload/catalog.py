"""Registry of the queries that exercise the operators on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.sources.listing import dealt
from clinlake.workspace import scratch_path
from workload.views import VIEWS, in_spark_sql, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(
    name: str, oracle: str | None = None, views: tuple[str, ...] = (), longs: tuple[str, ...] = ()
):
    """Register a query; ``views`` are the derived views that its SQL refers to.

    ``longs`` are the SQL's sums and counts that DuckDB types wider than BIGINT.
    """

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            sql = oracle
            if longs:
                casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in longs)
                sql = f"SELECT * REPLACE ({casts}) FROM ({sql})"
            ORACLES[name] = with_views(sql, views)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, deal: bool = False) -> DataFrame:
    """A derived view, from the same expressions that its SQL is made of.

    ``deal`` deals the rows of its table over tasks first, where much is made of each of them:
    a table of few bytes is read by few tasks.
    """
    base, columns = VIEWS[name]
    expressions = [f"{in_spark_sql(e)} AS {c}" for c, e in columns.items()]
    rows = table(spark, sf_dir, base)
    return (dealt(rows) if deal else rows).selectExpr(*expressions)


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and instants without zone, so both engines print them alike."""
    shaped = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            shaped.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            shaped.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            shaped.append(F.col(f.name))
    return df.select(*shaped)


def saved(spark: SparkSession, df: DataFrame, label: str, fmt: str = "parquet", **options) -> str:
    """Write a frame into the shared scratch folder and return its path."""
    path = scratch_path(spark, label)
    df.write.format(fmt).options(**options).save(path)
    return path
