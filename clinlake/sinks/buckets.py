"""Linear hashing: key buckets that split one by one as a table grows.

With n buckets, 2**level <= n < 2**(level + 1), a key's bucket is its hash modulo
2**(level + 1), or modulo 2**level where that bucket does not exist yet. So going
from n to n + 1 buckets moves keys of one bucket only, into the new one.

The number of buckets need not be stored: if the last buckets are empty, keys lie
where fewer buckets would have put them, so the highest bucket that has files tells.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX = "_bucket"
_JOINT = "__"


def bucket_column(keys: Sequence[str]) -> str:
    """Name of the partition column of a table laid out by these keys; it names them."""
    if not keys or any(_JOINT in k for k in keys):
        raise ValueError(f"cannot lay out by {list(keys)}: key names must not contain {_JOINT!r}")
    return _JOINT.join([PREFIX, *keys])


def keys_of(column: str) -> list[str]:
    return column.split(_JOINT)[1:]


def bucket_number(keys: Sequence[str], n: int) -> Column:
    """Bucket of a row among n; NULL keys have one too."""
    level = n.bit_length() - 1
    low = F.xxhash64(*[F.col(f"`{k}`") for k in keys]).bitwiseAND(F.lit((2 << level) - 1))
    return F.when(low >= n, low - (1 << level)).otherwise(low).cast("int")


def origin(bucket: int, n: int) -> int:
    """Which of n buckets holds the keys that a later bucket is going to have."""
    while bucket >= n:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def splitting(n: int, grown: int) -> set[int]:
    """Buckets of n that are split on the way to ``grown``: at most one for every new bucket."""
    return {origin(b, n) for b in range(n, grown)}


def newest(paths: Iterable[str]) -> dict[int, str]:
    """Bucket -> folder; a later folder of a bucket replaces an earlier one."""
    return {int(p.rsplit("=", 1)[1]): p for p in paths}
