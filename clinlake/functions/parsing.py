"""Column functions that turn untyped source strings into values.

All of them return NULL for input they cannot read; none of them raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_timestamp(value: Column | str) -> Column:
    """Timestamp; a bare date becomes that day's midnight."""
    raw = as_column(value)
    return F.coalesce(raw.try_cast("timestamp"), raw.try_cast("date").cast("timestamp"))


def safe_date(value: Column | str) -> Column:
    """Date; of a date-time string its date part."""
    return as_column(value).try_cast("date")


def safe_number(value: Column | str) -> Column:
    """Double, or NULL for qualitative results such as ``Positive``."""
    return as_column(value).try_cast("double")


def number_or_zero(value: Column | str, missing_mark: str = ".") -> Column:
    """Double, with the missing mark, NULL and unreadable text all read as 0.0."""
    text = as_column(value).cast("string")
    return F.coalesce(F.nullif(text, F.lit(missing_mark)).try_cast("double"), F.lit(0.0))


def normalise(value: Column | str) -> Column:
    """Upper case without surrounding blanks."""
    return F.upper(F.trim(as_column(value)))


def normalise_dotless(value: Column | str) -> Column:
    """Normalised code without its dots, so ``E11.9`` and ``e119`` meet."""
    return F.replace(normalise(value), F.lit("."), F.lit(""))


def info_value(info: Column | str, key: str) -> Column:
    """Value of one ``KEY=value`` entry of a ``;`` list; '' when the key is absent.

    The key has to start an entry: ``XGENE=A`` does not answer for ``GENE``.
    """
    return F.regexp_extract(as_column(info), f"(?:^|;){key}=([^;]+)", 1)


def date_parts(value: Column | str) -> tuple[Column, Column, Column]:
    """Year, month and day of month."""
    moment = as_column(value)
    return F.year(moment), F.month(moment), F.dayofmonth(moment)


def joined_source_value(*parts: Column | str) -> Column:
    """``:``-joined source value; absent parts are left out."""
    return F.concat_ws(":", *[as_column(p) for p in parts])


def iso_text(value: Column | str, data_type: T.DataType) -> Column:
    """Text form used by pattern rules: instants as ISO-8601, everything else as is."""
    column = as_column(value)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, ISO_INSTANT)
    return column.cast("string")


def is_sha256(value: Column | str) -> Column:
    """True for 64 hex digits, blanks around them allowed; NULL counts as false."""
    return F.coalesce(F.trim(as_column(value)).rlike("^[a-fA-F0-9]{64}$"), F.lit(False))
