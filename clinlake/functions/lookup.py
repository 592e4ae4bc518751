"""Dictionary enrichment: source code -> standard concept id.

Two forms with one meaning. A handful of codes becomes a map literal that is
evaluated inside the projection. A vocabulary table is joined: broadcast while
its bytes are checked to be few, and beyond that as a shuffle join that splits
the codes which are counted to be hot. Codes that meet once they are normalised
have one concept in every form: the smallest of theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.functions.joins import HOT_ROWS, left_join_split
from clinlake.functions.parsing import as_column, normalise, normalise_dotless

MAP_LITERAL_ENTRIES = 200
BROADCAST_BYTES = 64 * 1024 * 1024


def usable_entries(mapping: Mapping[str, Any]) -> dict[str, int]:
    """Entries that map a code to an integer; remarks (leading ``_``) are left out."""
    entries: dict[str, int] = {}
    for code, concept in mapping.items():
        if str(code).startswith("_"):
            continue
        try:
            entries[str(code)] = int(concept)
        except (TypeError, ValueError):
            pass
    return entries


def rekeyed(mapping: Mapping[str, Any], form: Callable[[str], str]) -> dict[str, int]:
    """Usable entries under another form of their codes; the smallest concept wins where codes meet."""
    entries: dict[str, int] = {}
    for code, concept in usable_entries(mapping).items():
        key = form(code)
        entries[key] = min(concept, entries.get(key, concept))
    return entries


def upper_keys(mapping: Mapping[str, Any]) -> dict[str, int]:
    """Usable entries under their normalised codes."""
    return rekeyed(mapping, lambda code: code.strip().upper())


def dotless_keys(mapping: Mapping[str, Any]) -> dict[str, int]:
    """Usable entries under their normalised codes with the dots taken out."""
    return rekeyed(mapping, lambda code: code.strip().upper().replace(".", ""))


def _as_written(code: Column | str) -> Column:
    return as_column(code)


# How a code and the codes of its vocabulary are brought into one form.
CODE_FORMS = {
    "exact": (_as_written, usable_entries),
    "normalised": (normalise, upper_keys),
    "dotless": (normalise_dotless, dotless_keys),
}


def concept_of(code: Column | str, mapping: Mapping[str, Any], default: int = 0) -> Column:
    """Concept id of a code; the default for NULL and for codes that are not mapped."""
    entries = usable_entries(mapping)
    fallback = F.lit(default).cast("int")
    if not entries:
        return fallback
    literal = F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])
    return F.coalesce(literal[as_column(code)].cast("int"), fallback)


def icd10_concept_of(code: Column | str, mapping: Mapping[str, Any], default: int = 0) -> Column:
    """Concept of a diagnosis code, dotted or dotless, in any case."""
    return concept_of(normalise_dotless(code), dotless_keys(mapping), default)


def normalised_concept_of(
    code: Column | str, mapping: Mapping[str, Any], default: int = 0
) -> Column:
    """Concept of a code after normalising both the code and the mapping's keys."""
    return concept_of(normalise(code), upper_keys(mapping), default)


# Bytes of the longest usual text of types whose texts are bounded: no value of theirs is turned into text to be measured.
FIXED_WIDTHS = {
    T.BooleanType: 5, T.ByteType: 4, T.ShortType: 6, T.IntegerType: 11, T.LongType: 20, T.FloatType: 15,
    T.DoubleType: 24, T.DateType: 10, T.TimestampType: 26, T.TimestampNTZType: 26,
}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 16, the longest text of its numbers and instants, and the text of all other values."""
    width = F.lit(16 + sum(FIXED_WIDTHS.get(type(f.dataType), 0) for f in df.schema.fields))
    for f in df.schema.fields:
        if type(f.dataType) not in FIXED_WIDTHS:
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
    return width.cast("bigint")


def text_bytes(df: DataFrame) -> int:
    """Bytes of a frame, added up by every task for its own rows."""
    return df.agg(F.sum(row_bytes(df)).alias("n")).first()["n"] or 0


def size_at_most(df: DataFrame, size: int) -> bool:
    """Size check in bytes."""
    return text_bytes(df) <= size


def distinct_codes(vocabulary: DataFrame, code: str, concept: str) -> DataFrame:
    """One concept per code; the smallest wins when a code is listed twice."""
    return (
        vocabulary.where(F.col(code).isNotNull() & F.col(concept).isNotNull())
        .groupBy(code)
        .agg(F.min(concept).alias(concept))
    )


def join_concepts(
    df: DataFrame,
    code: Column | str,
    vocabulary: DataFrame,
    out: str,
    default: int = 0,
    vocabulary_code: str = "source_code",
    vocabulary_concept: str = "concept_id",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Append the concept of ``code`` as column ``out``, from a vocabulary table."""
    kept = df.columns
    names = distinct_codes(vocabulary, vocabulary_code, vocabulary_concept).select(
        F.col(vocabulary_code).alias("_code"), F.col(vocabulary_concept).alias("_concept")
    )
    keyed = df.withColumn("_lookup", as_column(code))
    if size_at_most(names, broadcast_bytes):
        joined = keyed.join(F.broadcast(names), F.col("_lookup") == F.col("_code"), "left")
    else:
        joined = left_join_split(keyed, names.withColumnRenamed("_code", "_lookup"), "_lookup", hot_rows)
    return joined.select(
        *kept, F.coalesce(F.col("_concept"), F.lit(default)).cast("int").alias(out)
    )


def with_concept(
    df: DataFrame,
    out: str,
    code: Column | str,
    vocabulary: Mapping[str, Any] | DataFrame,
    form: str = "normalised",
    default: int = 0,
) -> DataFrame:
    """Append the concept of ``code``, by whichever form suits the vocabulary's size.

    Spark searches a map literal entry by entry, so only a dictionary of a few codes
    is used that way; a larger one, or a vocabulary table, is joined.
    """
    shape, entries_of = CODE_FORMS[form]
    if not isinstance(vocabulary, DataFrame):
        entries = entries_of(vocabulary)
        if len(entries) <= MAP_LITERAL_ENTRIES:
            return df.withColumn(out, concept_of(shape(code), entries, default))
        table = df.sparkSession.createDataFrame(
            list(entries.items()), "source_code string, concept_id int"
        )
    else:
        table = vocabulary.select(shape("source_code").alias("source_code"), "concept_id")
    return join_concepts(df, shape(code), table, out, default)
