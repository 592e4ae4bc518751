"""The audit checks: run evidence, commit logs, schemas; and their combination."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake import fixed_values as fixed
from clinlake.functions.parsing import is_sha256
from clinlake.functions.joins import HOT_ROWS, left_join_split
from clinlake.operators.checks import Check
from clinlake.sources.commitlog import schema_names

RUN = "MLFLOW_LINEAGE"
LOG = "DELTA_TRANSACTION_LOG"
PART_11 = "CFR_PART_11"
SCHEMA = "SCHEMA_INTEGRITY"

# What it means that a check passed, and that it failed.
WORDING = {
    "MLF_001": ("The ledger holds the run with its parameters and metrics.", ""),
    "MLF_ERR": ("", "The ledger holds no run of this id."),
    "CFR_11_10_E_DATA": ("The data that went in can be told by their digest.", "Nothing proves which data went in."),
    "CFR_11_10_E_RULES": ("The contract that was applied can be told by its digest.", "Nothing proves which contract was applied."),
    "CFR_11_10_A_VALIDATION": ("Every rule of the contract held.", "The gate is unproven or rules of the contract were broken."),
    "CFR_11_10_K_CONFIG": ("The run says what it was held against and where it ran.", "The run leaves open what it was held against or where it ran."),
    "CFR_11_10_MLF_SKIPPED": ("The audit covers no run.", ""),
    "DLT_001": ("", "The table has no commit log."),
    "DLT_002": ("", "The table's commit log holds no commit."),
    "DLT_SEQ_001": ("No commit is missing between the first and the last.", "Commits are missing or listed twice."),
    "DLT_TIME_002": ("Every commit is as late as the one before it, or later.", "Commits are dated before their predecessors."),
    "DLT_ERR": ("", "The commit log cannot be trusted, as lines of it cannot be read."),
    "CFR_11_10_E_DELTA": ("All commits say what they did.", "Commits do not say what they did."),
    "SCH_001": ("No mandatory column is missing.", "Mandatory columns are missing."),
    "SCH_002": ("The table's own columns are unknown.", ""),
}


def run_lookup_checks() -> list[Check]:
    """Was the requested run found in the ledger?"""
    found = F.col("run_evidence") == "COLLECTED"
    return [
        Check(
            "MLF_001", RUN, "Run found in the ledger", F.lit(True), "INFO", applies=found,
            details={
                "run_id": F.col("run_id"),
                "status": F.col("status"),
                "artifact_count": F.greatest(F.size("artifacts"), F.lit(0)),
            },
            wording=WORDING["MLF_001"],
        ),
        Check(
            "MLF_ERR", RUN, "Run missing from the ledger", F.lit(False), "CRITICAL_FATAL",
            applies=F.col("run_evidence") == "ERROR", details={"run_id": F.col("run_id")},
            wording=WORDING["MLF_ERR"],
        ),
    ]


def part_11_checks() -> list[Check]:
    """Provenance hashes, gate result and configuration of a run."""
    found = F.col("run_evidence") == "COLLECTED"
    params, metrics = F.col("params"), F.col("metrics")
    data_hash, rules_hash = params["data_sha256"], params["rules_sha256"]
    in_memory = F.coalesce(data_hash == fixed.IN_MEMORY_DATA, F.lit(False))
    unsuccessful = F.coalesce(metrics["unsuccessful_expectations"], F.lit(0.0))
    settings = {
        name: params[name]
        for name in ("compliance_standard", "target_schema", "execution_environment")
    }
    configured = F.lit(True)
    for value in settings.values():
        configured = configured & (F.coalesce(value, F.lit("")) != "")
    return [
        Check(
            "CFR_11_10_E_DATA", PART_11, "Source data carry a SHA-256 digest",
            is_sha256(data_hash) | in_memory, "CRITICAL_FATAL", applies=found,
            details={"data_sha256": data_hash, "in_memory": in_memory},
            wording=WORDING["CFR_11_10_E_DATA"],
        ),
        Check(
            "CFR_11_10_E_RULES", PART_11, "Contract rules carry a SHA-256 digest",
            is_sha256(rules_hash), "CRITICAL_FATAL", applies=found,
            details={"rules_sha256": rules_hash},
            wording=WORDING["CFR_11_10_E_RULES"],
        ),
        Check(
            "CFR_11_10_A_VALIDATION", PART_11, "Contract gate passed without a failed rule",
            (metrics["gxp_gate_passed"] == 1.0) & (unsuccessful == 0.0), "CRITICAL_FATAL",
            applies=found,
            details={
                "gxp_gate_passed": metrics["gxp_gate_passed"],
                "unsuccessful_expectations": unsuccessful,
            },
            wording=WORDING["CFR_11_10_A_VALIDATION"],
        ),
        Check(
            "CFR_11_10_K_CONFIG", PART_11, "Standard, target schema and environment declared",
            configured, "WARNING", applies=found, details=settings,
            wording=WORDING["CFR_11_10_K_CONFIG"],
        ),
        Check(
            "CFR_11_10_MLF_SKIPPED", PART_11, "No run was named for this audit", F.lit(True),
            "INFO", applies=F.col("run_evidence") == "SKIPPED",
            wording=WORDING["CFR_11_10_MLF_SKIPPED"],
        ),
    ]


def commit_log_checks() -> list[Check]:
    """Existence, sequence and times of a table's commit log."""
    state = F.col("log_evidence")
    collected = state == "COLLECTED"
    return [
        Check(
            "DLT_001", LOG, "Commit log is missing", F.lit(False), "CRITICAL_FATAL",
            applies=state == "MISSING_LOG", details={"table_id": F.col("table_id")},
            wording=WORDING["DLT_001"],
        ),
        Check(
            "DLT_002", LOG, "Commit log is empty", F.lit(False), "CRITICAL_FATAL",
            applies=state == "EMPTY_LOG", details={"table_id": F.col("table_id")},
            wording=WORDING["DLT_002"],
        ),
        Check(
            "DLT_SEQ_001", LOG, "Commit versions are consecutive", F.col("is_continuous"),
            "CRITICAL_FATAL", "INFO", applies=collected,
            details={
                "first_version": F.col("first_version"),
                "last_version": F.col("last_version"),
                "total_commits": F.col("total_commits"),
            },
            wording=WORDING["DLT_SEQ_001"],
        ),
        Check(
            "DLT_TIME_002", LOG, "Commit times never go backwards", F.col("is_monotonic"),
            "ERROR", "INFO", applies=collected,
            details={"time_setbacks": F.col("time_setbacks")},
            wording=WORDING["DLT_TIME_002"],
        ),
        Check(
            "DLT_ERR", LOG, "Commit log has unreadable lines", F.lit(False), "ERROR",
            applies=state == "ERROR", details={"unreadable_lines": F.col("unreadable_lines")},
            wording=WORDING["DLT_ERR"],
        ),
        Check(
            "CFR_11_10_E_DELTA", PART_11, "Every commit names its operation",
            F.col("commits_without_operation") == 0, "WARNING", applies=collected,
            details={
                "total_commits": F.col("total_commits"),
                "commits_without_operation": F.col("commits_without_operation"),
            },
            wording=WORDING["CFR_11_10_E_DELTA"],
        ),
    ]


def expected_columns(contract_columns: Sequence[str] | None = None) -> dict[str, list[str]]:
    """Mandatory columns per table: PERSON by its contract, the others by the registry."""
    required = {name: list(columns) for name, columns in fixed.REQUIRED_COLUMNS.items()}
    if contract_columns is None:
        rule = next(
            r for r in fixed.DEFAULT_CONTRACT["expectations"]
            if r["expectation_type"] == fixed.RULE_COLUMNS
        )
        contract_columns = rule["kwargs"]["column_set"]
    return {**required, "person": list(contract_columns)}


def schema_checks(
    expected: Mapping[str, Sequence[str]], table_name: Column | None = None
) -> list[Check]:
    """Does the table's latest schema hold its mandatory columns?"""
    folder_name = F.lower(F.regexp_extract("table_id", r"([^/]+)/*$", 1))
    name = folder_name if table_name is None else table_name
    pairs = [
        x
        for table, columns in expected.items()
        for x in (F.lit(table), F.array(*[F.lit(c) for c in columns]))
    ]
    wanted = F.coalesce(F.create_map(*pairs)[name], F.array().cast("array<string>"))
    present = schema_names(F.col("schema_string"))
    missing = F.array_except(wanted, present)
    readable = present.isNotNull()
    return [
        Check(
            "SCH_001", SCHEMA, "Table holds its mandatory columns", F.size(missing) == 0,
            "CRITICAL_FATAL", "INFO", applies=readable,
            details={"missing_columns": F.array_join(missing, ",")},
            wording=WORDING["SCH_001"],
        ),
        Check(
            "SCH_002", SCHEMA, "Only the expected columns are known", F.lit(True), "INFO",
            applies=~readable, details={"expected_columns": F.array_join(wanted, ",")},
            wording=WORDING["SCH_002"],
        ),
    ]


def log_evidence(targets: DataFrame, tables: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Roll-ups of the tables that are to be audited, with the state of their log.

    ``targets`` holds ``table_id`` and may hold ``log_exists``; a table without any
    commit has an empty log, or none at all when ``log_exists`` says so.
    """
    joined = left_join_split(targets, tables, "table_id", hot_rows)
    exists = F.col("log_exists") if "log_exists" in targets.columns else F.lit(True)
    state = (
        F.when(F.col("table_id").isNull(), "SKIPPED")
        .when(F.col("unreadable_lines") > 0, "ERROR")
        .when(F.col("total_commits") > 0, "COLLECTED")
        .when(F.coalesce(exists, F.lit(True)), "EMPTY_LOG")
        .otherwise("MISSING_LOG")
    )
    return joined.withColumn("log_evidence", state)


def audit_evidence(
    targets: DataFrame, runs: DataFrame, tables: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Everything known about each audit target (``audit_id, run_id, table_id``).

    Targets without an id, and many targets of one run or table, are spread over tasks.
    """
    with_log = log_evidence(targets, tables, hot_rows)
    joined = left_join_split(with_log, runs, "run_id", hot_rows, counted=targets)
    state = F.when(F.col("run_id").isNull(), "SKIPPED").otherwise(
        F.coalesce("run_evidence", F.lit("ERROR"))
    )
    return joined.withColumn("run_evidence", state)


def all_checks(expected: Mapping[str, Sequence[str]] | None = None) -> list[Check]:
    """The checks of a full audit over a run, a table, or both."""
    return [
        *run_lookup_checks(),
        *commit_log_checks(),
        *part_11_checks(),
        *schema_checks(expected_columns() if expected is None else expected),
    ]
