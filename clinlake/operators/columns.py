"""Shaping operators: projection onto a layout, adaptive columns, union, row cap."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(
    df: DataFrame,
    values: Mapping[str, Any],
    layout: Mapping[str, str],
    keep_type: Collection[str] = (),
) -> DataFrame:
    """Project onto a layout (column -> type), in its order and with its types.

    Layout columns without a value become typed NULLs; plain Python values become
    constants. Columns in ``keep_type`` are passed on in the type they come in.
    """
    unknown = set(values) - set(layout)
    if unknown:
        raise ValueError(f"columns outside the layout: {sorted(unknown)}")
    shaped = []
    for name, data_type in layout.items():
        value = values.get(name)
        column = value if isinstance(value, Column) else F.lit(value)
        if name not in keep_type:
            column = column.cast(data_type)
        shaped.append(column.alias(name))
    return df.select(*shaped)


def present_name(df: DataFrame, *candidates: str) -> str | None:
    """First candidate that is a column of the frame, whatever its case."""
    by_lower_name = {name.lower(): name for name in df.columns}
    for candidate in candidates:
        if candidate.lower() in by_lower_name:
            return by_lower_name[candidate.lower()]
    return None


def first_present(
    df: DataFrame, *candidates: str, absent: Any = None, data_type: str = "string"
) -> Column:
    """The first available of several input columns, else a typed constant (NULL)."""
    name = present_name(df, *candidates)
    return F.col(name) if name else F.lit(absent).cast(data_type)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns missing on one side are NULL there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def cap_rows(df: DataFrame, rows: int, order: Sequence[str] = ()) -> DataFrame:
    """At most ``rows`` rows; the same ones on every run when an order is given."""
    return (df.orderBy(*order) if order else df).limit(rows)


def rename_known(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns by a map; names that do not occur are ignored."""
    return df.withColumnsRenamed(dict(names))
