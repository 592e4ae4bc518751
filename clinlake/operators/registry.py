"""Registered OMOP schemas, and how far a table conforms to its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.fixed_values import CLUSTER_KEYS, PRIMARY_KEYS, REGISTERED_SCHEMAS, REQUIRED_COLUMNS

REGISTRY_LAYOUT = (
    "table_name string, ordinal int, column_name string, data_type string, nullable boolean, "
    "is_primary_key boolean, is_cluster_key boolean"
)


def registered_name(table: str) -> str:
    name = table.strip().lower()
    if name not in REGISTERED_SCHEMAS:
        raise KeyError(f"{table} is not registered; known: {', '.join(REGISTERED_SCHEMAS)}")
    return name


def registry_rows(table: str) -> list[tuple]:
    """Registered columns of one table, in the order of ``REGISTRY_LAYOUT``."""
    name = registered_name(table)
    return [
        (
            name, i, column, data_type, column not in REQUIRED_COLUMNS[name],
            column in PRIMARY_KEYS[name], column in CLUSTER_KEYS[name],
        )
        for i, (column, data_type) in enumerate(REGISTERED_SCHEMAS[name].items())
    ]


def registry(spark: SparkSession, *tables: str) -> DataFrame:
    """Columns of the registered tables, one row for each."""
    wanted = tables or tuple(REGISTERED_SCHEMAS)
    return spark.createDataFrame(
        [row for t in wanted for row in registry_rows(t)], REGISTRY_LAYOUT
    )


def conformance(df: DataFrame, table: str) -> DataFrame:
    """Registered and actual columns side by side, one row per column.

    Names and types are compared when the plan is built; NULLs are counted for all
    columns in one aggregate over the table.
    """
    name = table.strip().lower()
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    registered = {row[2]: row for row in registry_rows(name)}
    measures = [F.count(F.lit(1)).alias("n")]
    measures += [F.count(F.col(c)).alias(f"filled_{i}") for i, c in enumerate(actual)]
    position = {c: i for i, c in enumerate(actual)}
    lines = []
    for column in [*registered, *[c for c in actual if c not in registered]]:
        expected = registered.get(column)
        nulls = F.lit(None)
        if column in actual:
            nulls = F.col("n") - F.col(f"filled_{position[column]}")
        if expected is None:
            state = F.lit("EXTRA")
        elif column not in actual:
            state = F.lit("MISSING")
        elif actual[column] != expected[3]:
            state = F.lit("TYPE_MISMATCH")
        elif expected[4]:
            state = F.lit("OK")
        else:
            state = F.when(nulls > 0, "NULLS_IN_REQUIRED").otherwise("OK")
        lines.append(
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(expected[3] if expected else None).cast("string").alias("registered_type"),
                F.lit(actual.get(column)).cast("string").alias("actual_type"),
                F.lit(expected[4] if expected else None).cast("boolean").alias("nullable"),
                F.lit(bool(expected and expected[5])).alias("is_primary_key"),
                F.lit(bool(expected and expected[6])).alias("is_cluster_key"),
                nulls.cast("bigint").alias("null_rows"),
                F.col("n").alias("table_rows"),
                state.alias("status"),
            )
        )
    return df.agg(*measures).select(F.explode(F.array(*lines)).alias("c")).select("c.*")


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Mandatory columns of the registered schema that the frame does not have."""
    return [c for c in REQUIRED_COLUMNS[registered_name(table)] if c not in df.columns]
