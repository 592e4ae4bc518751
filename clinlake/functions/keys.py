"""64-bit surrogate keys.

``masked``    clears the sign bit of the hash; every key style returns a value >= 0
``absolute``  absolute value of the hash, for tables that already hold such ids
``digest``    first 60 bits of SHA-256, which any SQL engine can reproduce
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinlake.functions.parsing import as_column

KEY_STYLES = ("masked", "absolute", "digest")
LARGEST_KEY = 2**63 - 1
SMALLEST_LONG = -(2**63)
# Stands for a NULL part, so that (a, NULL, b) and (a, b, NULL) stay apart.
NULL_PART = "\0"


def key_text(parts: Sequence[Column | str]) -> Column:
    """Text that identifies a row: one part as it is, several joined with ``:``."""
    columns = [as_column(p).cast("string") for p in parts]
    if len(columns) == 1:
        return columns[0]
    joined = F.concat_ws(":", *[F.coalesce(c, F.lit(NULL_PART)) for c in columns])
    nothing_known = reduce(and_, [c.isNull() for c in columns])
    return F.when(~nothing_known, joined)


def digest_key(text: Column) -> Column:
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def surrogate_key(*parts: Column | str, style: str = "masked") -> Column:
    """Key over one or more columns; NULL when nothing identifies the row."""
    text = key_text(parts)
    if style == "digest":
        return digest_key(text)
    hashed = F.xxhash64(text)
    if style == "masked":
        key = hashed.bitwiseAND(F.lit(LARGEST_KEY))
    elif style == "absolute":
        key = F.when(hashed == F.lit(SMALLEST_LONG), F.lit(LARGEST_KEY)).otherwise(F.abs(hashed))
    else:
        raise ValueError(f"key style {style!r} is not one of {KEY_STYLES}")
    return F.when(text.isNotNull(), key)
