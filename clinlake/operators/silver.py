"""Bronze -> silver: typed helper columns, accept predicates, quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.fixed_values import ACCEPTED_GENDERS, ACCEPTED_VARIANT_FILTERS
from clinlake.functions.parsing import normalise, safe_date, safe_timestamp


@dataclass(frozen=True)
class Split:
    """Rows that pass a predicate and all the others; together they are the input."""

    accepted: DataFrame
    rejected: DataFrame


def holds(condition: Column) -> Column:
    """The condition with "unknown" read as false."""
    return F.coalesce(condition, F.lit(False))


def split_rows(df: DataFrame, condition: Column) -> Split:
    """Accepted rows and their exact complement, NULL outcomes included."""
    return Split(df.where(holds(condition)), df.where(~holds(condition)))


def parse_patients(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("parsed_birth_dt", safe_timestamp("birth_datetime"))


def parse_diagnoses(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("parsed_diag_dt", safe_date("diagnosis_date"))


def parse_labs(bronze: DataFrame) -> DataFrame:
    stamped = bronze.withColumn("parsed_lab_datetime", safe_timestamp("lab_datetime"))
    return stamped.withColumn("parsed_lab_dt", F.col("parsed_lab_datetime").cast("date"))


def patient_is_valid() -> Column:
    """Readable birth date, a known gender code, and an id to key the person on."""
    return (
        F.col("parsed_birth_dt").isNotNull()
        & normalise("gender").isin(*ACCEPTED_GENDERS)
        & F.col("raw_patient_id").isNotNull()
    )


def diagnosis_is_valid() -> Column:
    return F.col("parsed_diag_dt").isNotNull() & F.col("raw_patient_id").isNotNull()


def lab_is_valid() -> Column:
    return F.col("parsed_lab_dt").isNotNull() & F.col("raw_patient_id").isNotNull()


def variant_is_valid() -> Column:
    """Called variants: FILTER is PASS or was not applied. NULL does not qualify."""
    return F.col("filter").isin(*ACCEPTED_VARIANT_FILTERS)


def silver_patients(bronze: DataFrame) -> Split:
    return split_rows(parse_patients(bronze), patient_is_valid())


def silver_diagnoses(bronze: DataFrame) -> Split:
    return split_rows(parse_diagnoses(bronze), diagnosis_is_valid())


def silver_labs(bronze: DataFrame) -> Split:
    return split_rows(parse_labs(bronze), lab_is_valid())


def silver_variants(bronze: DataFrame) -> Split:
    return split_rows(bronze, variant_is_valid())


def tier_counts(parsed: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Accepted and quarantined rows per source: one scan and one row for each.

    ``parsed`` maps a source name to its parsed rows and its accept predicate.
    """
    counted = None
    for source, (df, condition) in parsed.items():
        row = df.agg(
            F.count_if(holds(condition)).alias("accepted"),
            F.count_if(~holds(condition)).alias("quarantined"),
        ).select(F.lit(source).alias("source"), "accepted", "quarantined")
        counted = row if counted is None else counted.unionByName(row)
    if counted is None:
        raise ValueError("no sources to count")
    return counted
