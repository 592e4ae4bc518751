"""Audit checks, scores, statuses, reports, receipts and sign-offs.

A check is a set of column expressions over one evidence row, so a list of checks
turns any number of subjects into findings, scores and reports within one
projection; nothing is exploded and grouped back together to get a score.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake import fixed_values as fixed
from clinlake.sources.commitlog import schema_fields

COMPLIANT = "COMPLIANT"
FLAGGED = "FLAGGED_FOR_REVIEW"
NON_COMPLIANT = "NON_COMPLIANT"
APPROVED = "APPROVED_BY_QA"
REJECTED = "REJECTED_BY_QA"


def always() -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Check:
    """One check. ``failed_severity`` holds when it fails, ``passed_severity`` otherwise.

    ``wording`` says in a sentence what it means that the check passed, and that it failed.
    """

    code: str
    category: str
    title: str
    passed: Column
    failed_severity: str
    passed_severity: str | None = None
    applies: Column = field(default_factory=always)
    details: Mapping[str, Column] = field(default_factory=dict)
    wording: tuple[str, str] = ("", "")

    # Columns are built once per check, however many results they go into.

    @cached_property
    def ok(self) -> Column:
        return F.coalesce(self.passed, F.lit(False))

    @cached_property
    def relevant(self) -> Column:
        return F.coalesce(self.applies, F.lit(False))

    @cached_property
    def fails(self) -> Column:
        return self.relevant & ~self.ok

    @cached_property
    def severity(self) -> Column:
        if self.passed_severity in (None, self.failed_severity):
            return F.lit(self.failed_severity)
        return F.when(self.ok, self.passed_severity).otherwise(self.failed_severity)

    @cached_property
    def description(self) -> Column:
        passed, failed = self.wording
        return F.when(self.ok, passed).otherwise(failed)

    def finding(self) -> Column:
        """The finding as a struct, its fields and details in alphabetical order; NULL where the check does not apply."""
        entries = [
            x
            for name, value in sorted(self.details.items())
            for x in (F.lit(name), F.coalesce(value.cast("string"), F.lit("")))
        ]
        details = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
        body = F.struct(
            F.lit(self.category).alias("category"),
            F.lit(self.code).alias("code"),
            self.description.alias("description"),
            details.alias("details"),
            self.ok.alias("passed"),
            self.severity.alias("severity"),
            F.lit(self.title).alias("title"),
        )
        return F.when(self.relevant, body)


def _count(conditions: Sequence[Column]) -> Column:
    return reduce(add, [c.cast("int") for c in conditions], F.lit(0))


def severity_weight(severity: Column) -> Column:
    weights = F.create_map(
        *[F.lit(x) for pair in fixed.SEVERITY_WEIGHTS.items() for x in pair]
    )
    known = F.coalesce(severity, F.lit(fixed.DEFAULT_SEVERITY))
    return F.coalesce(weights[known], F.lit(fixed.UNLISTED_SEVERITY_WEIGHT))


def clamp_score(penalty: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.lit(100.0) - penalty))


def status_of(critical: Column, error: Column, warning: Column, score: Column) -> Column:
    return (
        F.when((critical > 0) | (error > 0) | (score < fixed.SCORE_FLOOR_REVIEW), NON_COMPLIANT)
        .when((warning > 0) | (score < fixed.SCORE_FLOOR_COMPLIANT), FLAGGED)
        .otherwise(COMPLIANT)
    )


def findings(evidence: DataFrame, subject: Sequence[str], checks: Sequence[Check]) -> DataFrame:
    """One row per subject and applicable check."""
    listed = F.explode(F.array(*[c.finding() for c in checks])).alias("finding")
    rows = evidence.select(*subject, listed).where(F.col("finding").isNotNull())
    return rows.select(*subject, "finding.*")


def score_findings(rows: DataFrame, subject: Sequence[str]) -> DataFrame:
    """Score, failure counts and status per subject, from findings of any origin."""
    failed = ~F.coalesce("passed", F.lit(False))
    severity = F.coalesce("severity", F.lit(fixed.DEFAULT_SEVERITY))
    totals = rows.groupBy(*subject).agg(
        F.count(F.lit(1)).alias("total_evaluations"),
        F.count_if(~failed).alias("passed_evaluations"),
        F.count_if(failed & (severity == "CRITICAL_FATAL")).alias("critical_failures"),
        F.count_if(failed & (severity == "ERROR")).alias("error_failures"),
        F.count_if(failed & (severity == "WARNING")).alias("warning_failures"),
        F.sum(F.when(failed, severity_weight(severity)).otherwise(0.0)).alias("penalty"),
    )
    scored = totals.withColumn("compliance_score", clamp_score(F.col("penalty"))).drop("penalty")
    return scored.withColumn(
        "compliance_status",
        status_of(
            F.col("critical_failures"), F.col("error_failures"), F.col("warning_failures"),
            F.col("compliance_score"),
        ),
    )


def assess(evidence: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evidence rows with their findings, failure counts, score and status; row-wise."""

    def failing(severity: str) -> Column:
        return _count([c.fails for c in checks if c.failed_severity == severity])

    def weight(check: Check) -> float:
        return fixed.SEVERITY_WEIGHTS.get(check.failed_severity, fixed.UNLISTED_SEVERITY_WEIGHT)

    penalty = reduce(
        add, [F.when(c.fails, weight(c)).otherwise(0.0) for c in checks], F.lit(0.0)
    )
    by_code = sorted(checks, key=lambda c: c.code)
    counted = evidence.withColumns(
        {
            "findings": F.array_compact(F.array(*[c.finding() for c in by_code])),
            "total_evaluations": _count([c.relevant for c in checks]),
            "passed_evaluations": _count([c.relevant & c.ok for c in checks]),
            "critical_failures": failing("CRITICAL_FATAL"),
            "error_failures": failing("ERROR"),
            "warning_failures": failing("WARNING"),
            "compliance_score": clamp_score(penalty),
        }
    )
    return counted.withColumn(
        "compliance_status",
        status_of(
            F.col("critical_failures"), F.col("error_failures"), F.col("warning_failures"),
            F.col("compliance_score"),
        ),
    )


def _summary() -> Column:
    return F.struct(
        "critical_failures", "error_failures", "passed_evaluations", "total_evaluations",
        "warning_failures",
    )


def _evidence_summary(columns: Sequence[str]) -> Column:
    """What was found out about the run, the commit log and the schema."""

    def state(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit("SKIPPED")) if column in columns else F.lit("SKIPPED")

    known = schema_fields(F.col("schema_string")).isNotNull() if "schema_string" in columns else F.lit(False)
    return F.struct(
        state("log_evidence").alias("log"), state("run_evidence").alias("run"),
        F.when(known, "COLLECTED").otherwise("SKIPPED").alias("schema"),
    )


def _report_text(columns: Sequence[str], identifiers: Sequence[str], signoff: Column | None) -> Column:
    """Report in canonical JSON: keys in alphabetical order at every depth, no blanks, the score with two decimals.

    So any engine can write the same bytes and recompute the receipt, which is not part of them.
    """
    fields = {
        "audit_timestamp": F.col("audit_timestamp"),
        "compliance_score": F.col("compliance_score").cast("decimal(5,2)"),
        "compliance_status": F.col("compliance_status"),
        "evidence_summary": _evidence_summary(columns),
        "findings": F.col("findings"),
        "regulatory_standard": F.lit(fixed.REGULATORY_STANDARD),
        "summary": _summary(),
        "target_framework": F.lit(fixed.TARGET_FRAMEWORK),
        "target_identifiers": F.struct(*sorted(identifiers)),
    }
    if signoff is not None:
        fields["qa_signoff"] = signoff
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def report(
    assessed: DataFrame, identifiers: Sequence[str], audit_timestamp: str
) -> DataFrame:
    """Assessed rows with the report document and its SHA-256 receipt."""
    stamped = assessed.withColumn("audit_timestamp", F.lit(audit_timestamp))
    worded = stamped.withColumn("report_json", _report_text(stamped.columns, identifiers, None))
    return worded.withColumn("receipt_sha256", F.sha2("report_json", 256))


def latest_signoffs(signoffs: DataFrame, key: str) -> DataFrame:
    """The newest sign-off per audit."""
    body = F.struct(
        "timestamp", "operator_id", "decision", "justification", "signature_checksum"
    )
    return signoffs.groupBy(key).agg(F.max(body).alias("given"))


def sign_off(
    reports: DataFrame,
    signoffs: DataFrame,
    key: str,
    identifiers: Sequence[str],
    now: str,
) -> DataFrame:
    """Attach sign-offs to the audits that need one and issue a new receipt.

    Only flagged and non-compliant audits take a sign-off. Audits without one keep
    their status and wait (``awaiting_signoff``).
    """
    joined = reports.join(latest_signoffs(signoffs, key), key, "left")
    needs = F.col("compliance_status").isin(FLAGGED, NON_COMPLIANT)
    signed = needs & F.col("given").isNotNull()

    def field_or(name: str, fallback: str) -> Column:
        return F.coalesce(F.col(f"given.{name}"), F.lit(fallback))

    operator = field_or("operator_id", fixed.UNKNOWN_OPERATOR)
    decision = field_or("decision", fixed.UNSTATED_DECISION)
    reason = field_or("justification", fixed.UNSTATED_REASON)
    moment = field_or("timestamp", now)
    signature = F.coalesce(
        F.col("given.signature_checksum"),
        F.sha2(F.concat_ws(":", operator, decision, reason, moment), 256),
    )
    body = F.struct(
        decision.alias("decision"), reason.alias("justification"), operator.alias("operator_id"),
        signature.alias("signature_checksum"), moment.alias("timestamp"),
    )
    verdict = F.when(decision.isin(*fixed.APPROVING_DECISIONS), APPROVED).otherwise(REJECTED)
    resolved = joined.withColumns(
        {
            "qa_signoff": F.when(signed, body),
            "awaiting_signoff": needs & F.col("given").isNull(),
            "compliance_status": F.when(signed, verdict).otherwise(F.col("compliance_status")),
            "previous_receipt": F.when(signed, F.col("receipt_sha256")),
        }
    ).drop("given")
    has_signoff = F.col("qa_signoff").isNotNull()
    reworded = resolved.withColumn(
        "report_json",
        F.when(has_signoff, _report_text(resolved.columns, identifiers, F.col("qa_signoff"))).otherwise(
            F.col("report_json")
        ),
    )
    return reworded.withColumn("receipt_sha256", F.sha2("report_json", 256))


def certificates(reports: DataFrame, run_id: str = "run_id") -> DataFrame:
    """Tags and metrics that attach a report to its run."""
    tags = {
        "gxp_audit_status": F.col("compliance_status"),
        "gxp_audit_receipt_sha256": F.col("receipt_sha256"),
    }
    if "qa_signoff" in reports.columns:
        tags["gxp_qa_signer"] = F.col("qa_signoff.operator_id")
        tags["gxp_qa_decision"] = F.col("qa_signoff.decision")
    pairs = [x for name, value in tags.items() for x in (F.lit(name), value)]
    known = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    score = F.create_map(F.lit("gxp_audit_compliance_score"), F.col("compliance_score"))
    return reports.where(F.col(run_id).isNotNull()).select(
        F.col(run_id).alias("run_id"), known.alias("tags"), score.alias("metrics"), "report_json"
    )
