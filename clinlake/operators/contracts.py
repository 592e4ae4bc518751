"""Contract evaluation: all rules of a contract in one pass over the whole table.

Every rule becomes one or two aggregate columns, the table is aggregated once, and
the single result row is turned into one row per rule. A second form attaches the
violated rules to each row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.fixed_values import RULE_COLUMNS, RULE_IN_SET, RULE_NOT_NULL, RULE_REGEX
from clinlake.functions.parsing import iso_text
from clinlake.sources.contracts import Contract, Rule

EVALUATED = "EVALUATED"
SKIPPED = "SKIPPED"
MISSING_COLUMN = "MISSING_COLUMN"

_ROW_RULES = (RULE_NOT_NULL, RULE_REGEX, RULE_IN_SET)


class ContractBreach(RuntimeError):
    """Raised by the strict gate; carries the failed rules."""

    def __init__(self, name: str, failed: list[str]):
        super().__init__(f"contract {name}: {len(failed)} rule(s) failed: {'; '.join(failed)}")
        self.failed = failed


def _allowed(df: DataFrame, rule: Rule) -> Column:
    """Membership test; numbers are compared as numbers, mixed types by their text."""
    allowed = list(rule.options.get("value_set") or [])
    numeric = isinstance(df.schema[rule.column].dataType, T.NumericType)
    if numeric and all(isinstance(v, (int, float)) for v in allowed):
        return F.col(rule.column).isin(*allowed)
    return F.col(rule.column).cast("string").isin(*[str(v) for v in allowed])


def breaks(df: DataFrame, rule: Rule, whole_pattern_start: bool = False) -> Column:
    """True where a row breaks a column rule. NULL only breaks the not-null rule."""
    column = F.col(rule.column)
    if rule.kind == RULE_NOT_NULL:
        return column.isNull()
    if rule.kind == RULE_REGEX:
        pattern = rule.options.get("regex", "")
        if whole_pattern_start:
            pattern = f"^(?:{pattern})"
        matches = iso_text(rule.column, df.schema[rule.column].dataType).rlike(pattern)
        return F.coalesce(~matches, F.lit(False))
    if rule.kind == RULE_IN_SET:
        return F.coalesce(~_allowed(df, rule), F.lit(False))
    raise ValueError(f"not a rule about rows: {rule.kind}")


def column_set_differences(df: DataFrame, rule: Rule) -> list[str]:
    """Columns by which the table misses a column-set rule."""
    wanted = set(rule.options.get("column_set") or [])
    # Left out, the set has to match exactly.
    exact = rule.options.get("exact_match", True)
    off = wanted - set(df.columns)
    if exact:
        off |= set(df.columns) - wanted
    return sorted(off)


def rule_results(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per rule: status, rows looked at, rows that break it, success."""
    measures = [F.count(F.lit(1)).alias("n")]
    shaped: list[Column] = []
    for i, rule in enumerate(contract.rules):
        rows, bad, details = F.lit(0), F.lit(0), F.lit(None)
        if rule.kind == RULE_COLUMNS:
            off = column_set_differences(df, rule)
            status, rows, bad = EVALUATED, F.col("n"), F.lit(len(off))
            success = F.lit(not off)
            details = F.lit(",".join(off) or None)
        elif rule.kind not in _ROW_RULES:
            status, success = SKIPPED, F.lit(None)
        elif rule.column not in df.columns:
            status, success = MISSING_COLUMN, F.lit(False)
        else:
            status = EVALUATED
            measures.append(F.count_if(breaks(df, rule)).alias(f"bad_{i}"))
            bad = F.col(f"bad_{i}")
            if rule.kind == RULE_NOT_NULL:
                rows = F.col("n")
            else:
                measures.append(F.count(F.col(rule.column)).alias(f"seen_{i}"))
                rows = F.col(f"seen_{i}")
            tolerated = F.lit(1.0 - float(rule.options.get("mostly", 1.0)))
            success = (bad == 0) | (bad <= rows * tolerated)
        shaped.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(rule.kind).alias("expectation_type"),
                F.lit(rule.column).cast("string").alias("column_name"),
                F.lit(rule.severity).alias("severity"),
                F.lit(status).alias("status"),
                rows.cast("bigint").alias("evaluated_rows"),
                bad.cast("bigint").alias("unexpected_count"),
                success.cast("boolean").alias("success"),
                details.cast("string").alias("details"),
            )
        )
    totals = df.agg(*measures)
    if not shaped:
        return totals.where(F.lit(False)).select(
            *[F.lit(None).cast(t).alias(c) for c, t in _RESULT_TYPES.items()]
        )
    return totals.select(
        F.col("n").alias("total_records"), F.explode(F.array(*shaped)).alias("r")
    ).select("total_records", "r.*")


_RESULT_TYPES = {
    "total_records": "bigint", "position": "int", "expectation_type": "string",
    "column_name": "string", "severity": "string", "status": "string",
    "evaluated_rows": "bigint", "unexpected_count": "bigint", "success": "boolean",
    "details": "string",
}


def summarise(results: DataFrame) -> DataFrame:
    """Counts and success rate (0 to 100; 0 when nothing was evaluated) in one row."""
    counted = F.col("success").isNotNull()
    totals = results.agg(
        F.coalesce(F.max("total_records"), F.lit(0)).alias("total_records"),
        F.count_if(counted).alias("evaluated_expectations"),
        F.count_if(counted & F.col("success")).alias("successful_expectations"),
    )
    evaluated, passed = F.col("evaluated_expectations"), F.col("successful_expectations")
    return totals.select(
        (evaluated == passed).alias("success"),
        "total_records",
        "evaluated_expectations",
        "successful_expectations",
        (evaluated - passed).alias("unsuccessful_expectations"),
        F.when(evaluated > 0, passed / evaluated * 100.0)
        .otherwise(F.lit(0.0))
        .alias("success_rate"),
    )


@dataclass(frozen=True)
class GateResult:
    """Outcome of a gate: the summary and the rules behind it, both plain values."""

    contract: str
    success: bool
    total_records: int
    evaluated_expectations: int
    successful_expectations: int
    unsuccessful_expectations: int
    success_rate: float
    failed_rules: tuple[str, ...]
    # One entry per judged rule: its name, and whether it held.
    rules: tuple[tuple[str, bool], ...] = ()
    run_id: str | None = None


def _rule_name(row) -> str:
    return f"{row['expectation_type']}({row['column_name'] or row['details']})"


def run_gate(df: DataFrame, contract: Contract, strict: bool = False) -> GateResult:
    """Evaluate a contract on the full table. ``strict`` raises when a rule fails.

    What reaches the driver is one row per rule of the contract.
    """
    rows = rule_results(df, contract).collect()
    judged = [r for r in rows if r["success"] is not None]
    failed = [r for r in judged if not r["success"]]
    names = [_rule_name(r) for r in failed]
    if strict and failed:
        raise ContractBreach(contract.name, names)
    passed = len(judged) - len(failed)
    return GateResult(
        contract=contract.name,
        success=not failed,
        total_records=rows[0]["total_records"] if rows else 0,
        evaluated_expectations=len(judged),
        successful_expectations=passed,
        unsuccessful_expectations=len(failed),
        success_rate=100.0 * passed / len(judged) if judged else 0.0,
        failed_rules=tuple(names),
        rules=tuple((_rule_name(r), bool(r["success"])) for r in judged),
    )


def _violation(rule: Rule, message: Column) -> Column:
    return F.struct(
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.kind).alias("expectation_type"),
        F.lit(rule.severity).alias("severity"),
        message.alias("message"),
    )


def _message(rule: Rule) -> Column:
    value = F.coalesce(F.col(rule.column).cast("string"), F.lit("NULL"))
    text = {
        RULE_NOT_NULL: [F.lit(f"{rule.column} is null")],
        RULE_REGEX: [
            F.lit(f"{rule.column} = "), value, F.lit(f" does not match {rule.options.get('regex')}")
        ],
        RULE_IN_SET: [
            F.lit(f"{rule.column} = "), value,
            F.lit(f" is not one of {list(rule.options.get('value_set') or [])}"),
        ],
    }[rule.kind]
    return F.concat(*text)


def with_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Append ``violations`` (array) and ``valid`` to every row; stays row-wise.

    A rule about a column that the table does not have is violated by every row.
    """
    found: list[Column] = []
    for rule in contract.rules:
        if rule.kind not in _ROW_RULES:
            continue
        if rule.column not in df.columns:
            found.append(_violation(rule, F.lit(f"{rule.column} is missing")))
        else:
            broken = breaks(df, rule, whole_pattern_start=True)
            found.append(F.when(broken, _violation(rule, _message(rule))))
    if not found:
        entry = "column_name:string,expectation_type:string,severity:string,message:string"
        nothing = F.array().cast(f"array<struct<{entry}>>")
        return df.withColumns({"violations": nothing, "valid": F.lit(True)})
    marked = df.withColumn("violations", F.array_compact(F.array(*found)))
    return marked.withColumn("valid", F.size("violations") == 0)


def violations(df: DataFrame, contract: Contract, keys: Sequence[str]) -> DataFrame:
    """One row per violated rule, with the given key columns."""
    marked = with_violations(df, contract)
    return marked.select(*keys, F.inline("violations"))
