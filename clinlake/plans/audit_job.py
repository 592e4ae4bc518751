"""Audits of runs and table logs: many subjects in one job, or one from the shell."""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.fixed_values import RULE_COLUMNS
from clinlake.operators.audits import all_checks, audit_evidence, expected_columns
from clinlake.operators.checks import assess, certificates, report, sign_off
from clinlake.operators.commits import commit_rollup, table_rollup
from clinlake.operators.ledger import LEDGER_LAYOUT, read_ledger, run_evidence
from clinlake.sinks.tables import write_reports
from clinlake.sources.commitlog import LOG_FOLDER, scan_commit_log
from clinlake.sources.contracts import load_contract
from clinlake.sources.listing import present
from clinlake.workspace import canonical, path_exists

IDENTIFIERS = ("audit_id", "rules_path", "run_id", "table_id")
SIGNOFF_LAYOUT = (
    "audit_id string, operator_id string, decision string, justification string, "
    "timestamp string, signature_checksum string"
)


def audit(
    targets: DataFrame,
    ledger: DataFrame,
    actions: DataFrame,
    audit_timestamp: str,
    expected: Mapping[str, Sequence[str]] | None = None,
    identifiers: Sequence[str] = IDENTIFIERS,
) -> DataFrame:
    """Report of every target ``(audit_id, run_id, table_id[, rules_path])``; either id may be NULL.

    Runs are looked up in the ledger and tables in the roll-up of their log actions;
    checks, score, status, report document and receipt then come from one projection.
    """
    if "rules_path" not in targets.columns:
        targets = targets.withColumn("rules_path", F.lit(None).cast("string"))
    runs = run_evidence(targets, ledger)
    tables = table_rollup(commit_rollup(actions))
    evidence = audit_evidence(targets, runs, tables)
    return report(assess(evidence, all_checks(expected)), identifiers, audit_timestamp)


def _expected(spark: SparkSession, rules_path: str | None) -> dict[str, list[str]]:
    contract = load_contract(spark, rules_path)
    sets = [r.options.get("column_set") for r in contract.rules if r.kind == RULE_COLUMNS]
    return expected_columns(sets[-1] if sets else None)


def audit_paths(
    spark: SparkSession,
    targets: Sequence[tuple[str | None, str | None]],
    ledger_path: str | None = None,
    rules_path: str | None = None,
    now: str | None = None,
) -> DataFrame:
    """Audit named ``(run_id, table_path)`` pairs against a ledger and the tables' logs."""
    moment = now or datetime.now(UTC).isoformat()
    ids = {p: canonical(spark, p) for _, p in targets if p is not None}
    logs = {p: f"{p.rstrip('/')}/{LOG_FOLDER}" for p in ids}
    there = present(spark, list(logs.values()))
    rows = [
        (
            f"{run or ''}|{ids.get(path, '')}", run, ids.get(path),
            None if path is None else logs[path] in there, rules_path,
        )
        for run, path in targets
    ]
    wanted = spark.createDataFrame(
        rows, "audit_id string, run_id string, table_id string, log_exists boolean, rules_path string"
    )
    ledger = (
        read_ledger(spark, ledger_path)
        if ledger_path and path_exists(spark, ledger_path)
        else spark.createDataFrame([], LEDGER_LAYOUT)
    )
    actions = scan_commit_log(spark, list(ids))
    return audit(wanted, ledger, actions, moment, _expected(spark, rules_path))


def resume_with_signoff(
    reports: DataFrame, signoffs: DataFrame, now: str | None = None
) -> DataFrame:
    """Reports with the sign-offs that have been given for them so far."""
    moment = now or datetime.now(UTC).isoformat()
    return sign_off(reports, signoffs, "audit_id", IDENTIFIERS, moment)


def record(reports: DataFrame, output_path: str, certificate_path: str | None = None) -> None:
    """Write report documents and, for audits of a run, the run's certificates."""
    write_reports(reports, output_path)
    if certificate_path:
        certificates(reports).write.mode("append").parquet(certificate_path)


def main(argv: list[str] | None = None) -> DataFrame:
    parser = argparse.ArgumentParser(description="Audit a run and a table's commit log")
    parser.add_argument("--run-id")
    parser.add_argument("--table-path")
    parser.add_argument("--rules")
    parser.add_argument("--ledger")
    parser.add_argument("--enable-signoff", action="store_true")
    parser.add_argument("--signoffs", help="JSON lines with audit_id and the sign-off fields")
    parser.add_argument("--output")
    parser.add_argument("--certificates")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("clinlake-audit").getOrCreate()
    reports = audit_paths(spark, [(args.run_id, args.table_path)], args.ledger, args.rules)
    if args.enable_signoff:
        given = (
            spark.read.schema(SIGNOFF_LAYOUT).json(args.signoffs)
            if args.signoffs
            else spark.createDataFrame([], SIGNOFF_LAYOUT)
        )
        reports = resume_with_signoff(reports, given)
        if not reports.where("awaiting_signoff").isEmpty():
            print("waiting for a sign-off")
    if args.output:
        record(reports, args.output, args.certificates)
    row = reports.select(
        "compliance_status", "compliance_score", "receipt_sha256", F.size("findings").alias("n")
    ).first()
    print(f"{row['compliance_status']} {row['compliance_score']:.2f} {row['receipt_sha256']}")
    return reports


if __name__ == "__main__":
    main()
