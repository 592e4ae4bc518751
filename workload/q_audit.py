"""Commit logs, run ledger, findings, scores, reports and sign-offs."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinlake import fixed_values as fixed
from clinlake.operators import audits, checks, commits, ledger, sequence
from clinlake.plans import audit_job
from clinlake.sinks.tables import write_reports
from clinlake.sources import commitlog
from clinlake.workspace import scratch_path
from workload.catalog import plain, query, table, view
from workload.q_columns import R

C = ("commit_log",)
NOW = "2024-06-01T00:00:00+00:00"

# -- commit logs --------------------------------------------------------------------

PERSON_COLUMNS = audits.expected_columns()["person"]
MEASUREMENT_COLUMNS = audits.expected_columns()["measurement"]


def _schema_json(names) -> str:
    fields = ",".join(f'{{\\"name\\":\\"{n}\\",\\"type\\":\\"string\\",\\"nullable\\":true}}' for n in names)
    return f'{{\\"type\\":\\"struct\\",\\"fields\\":[{fields}]}}'


def _metadata_line(names, configuration: str = "{}", partitions: str = "[]") -> str:
    return (
        f'{{"metaData":{{"schemaString":"{_schema_json(names)}","partitionColumns":{partitions},'
        f'"configuration":{configuration}}}}}'
    )


def log_lines(spark, sf_dir):
    """The commit log as text: several JSON lines per commit, some of them not JSON."""
    log = view(spark, sf_dir, "commit_log", deal=True)
    block, hot = F.expr("event_id div 96"), F.col("table_id") == "lake/person"
    first, later = F.col("version") == 0, F.col("version") == 20
    feed = '{"delta.enableChangeDataFeed":"true"}'
    full = F.when(hot, _metadata_line(PERSON_COLUMNS, partitions='["person_id"]')).when(
        F.col("table_id").endswith("/measurement"),
        _metadata_line(MEASUREMENT_COLUMNS, partitions='["person_id"]'),
    ).otherwise(_metadata_line(["a"], partitions='["person_id"]'))
    narrow = F.lit(_metadata_line(["measurement_id", "person_id"], partitions='["person_id"]'))
    info = F.struct(
        F.col("commit_ts").alias("timestamp"),
        F.col("operation").alias("operation"),
        F.lit("engine").alias("engineInfo"),
        F.concat(F.lit("event "), "event_id").alias("userMetadata"),
    )
    lines = F.flatten(
        F.array(
            F.array(F.to_json(F.struct(info.alias("commitInfo")))),
            F.array_repeat(F.lit('{"add":{"path":"part-0","size":10}}'), (1 + F.col("event_id") % 3).cast("int")),
            F.array_repeat(F.lit('{"remove":{"path":"part-1"}}'), (F.col("event_id") % 2).cast("int")),
            F.when(
                first,
                F.array(
                    F.lit('{"protocol":{"minReaderVersion":3,"minWriterVersion":7}}'),
                    F.when((block % 3 == 0) | hot, _metadata_line(["person_id"], feed)).otherwise(
                        _metadata_line(["person_id"])
                    ),
                ),
            ).otherwise(F.array().cast("array<string>")),
            F.when(later, F.array(F.when(hot | (block % 4 == 0), full).otherwise(narrow))).otherwise(
                F.array().cast("array<string>")
            ),
            F.when(F.col("event_id") % 10 == 0, F.array(F.lit("not json"), F.lit(""))).otherwise(
                F.array().cast("array<string>")
            ),
            F.when(first & ~hot & (block % 11 == 10), F.array(F.lit("17"))).otherwise(
                F.array().cast("array<string>")
            ),
        )
    )
    name = F.concat(F.lpad(F.col("version").cast("string"), 20, "0"), F.lit(".json"))
    return log.select("table_id", name.alias("file_name"), F.explode(lines).alias("value"))


def actions(spark, sf_dir):
    return commitlog.parse_actions(log_lines(spark, sf_dir))


def commit_rows(spark, sf_dir):
    return commits.commit_rollup(actions(spark, sf_dir))


@query(
    "commit_log_scan",
    "SELECT table_id, version, count(*) AS commit_infos, sum(1 + event_id % 3) AS adds, "
    "sum(event_id % 2) AS removes, count_if(version IN (0, 20)) AS schemas, max(operation) AS operation "
    "FROM commit_log GROUP BY table_id, version",
    C,
    longs=("adds", "removes", "schemas"),
)
def commit_log_scan(spark, sf_dir):
    parsed = actions(spark, sf_dir)
    return parsed.groupBy("table_id", "version").agg(
        F.count("commitInfo").alias("commit_infos"),
        F.count("add").alias("adds"),
        F.count("remove").alias("removes"),
        F.count("metaData.schemaString").alias("schemas"),
        F.max("commitInfo.operation").alias("operation"),
    )


TABLE_FACTS = (
    "SELECT f.*, coalesce(b.time_setbacks, 0) AS time_setbacks FROM (SELECT table_id, count(*) AS total_commits, "
    "min(version) AS first_version, max(version) AS last_version, sum(1 + event_id % 3) AS total_add_actions, "
    "sum(event_id % 2) AS total_remove_actions, count_if(operation IS NULL) AS commits_without_operation, "
    "max(version) - min(version) + 1 = count(*) AS is_continuous, "
    "bool_or(version = 0 AND (table_id = 'lake/person' OR (event_id // 96) % 3 = 0)) AS change_feed, "
    "count_if(version = 0 AND table_id <> 'lake/person' AND (event_id // 96) % 11 = 10) AS unreadable_lines, "
    "bool_or(version = 20) AS has_later_schema, "
    "bool_or(version = 20 AND (table_id = 'lake/person' OR (event_id // 96) % 4 = 0)) AS has_full_schema "
    "FROM commit_log GROUP BY table_id) f LEFT JOIN (SELECT table_id, count(*) AS time_setbacks FROM "
    "(SELECT table_id, commit_ts, lag(commit_ts) OVER (PARTITION BY table_id ORDER BY version) AS before "
    "FROM commit_log WHERE commit_ts IS NOT NULL) WHERE commit_ts < before GROUP BY table_id) b "
    "ON f.table_id = b.table_id"
)


@query(
    "commit_log_rollup",
    "SELECT table_id, total_commits, first_version, last_version, total_add_actions, total_remove_actions, "
    "commits_without_operation, is_continuous, change_feed, unreadable_lines, time_setbacks, "
    "time_setbacks = 0 AS is_monotonic, CASE WHEN has_later_schema THEN 'person_id' ELSE '' END AS clustering "
    f"FROM ({TABLE_FACTS})",
    C,
    longs=("total_add_actions", "total_remove_actions", "commits_without_operation", "unreadable_lines"),
)
def commit_log_rollup(spark, sf_dir):
    rolled = commits.table_rollup(commit_rows(spark, sf_dir))
    return rolled.select(
        "table_id", "total_commits", "first_version", "last_version", "total_add_actions",
        "total_remove_actions", "commits_without_operation", "is_continuous", "change_feed",
        "unreadable_lines", "time_setbacks", "is_monotonic",
        F.array_join("clustering_columns", ",").alias("clustering"),
    )


@query(
    "commit_log_tail",
    "SELECT table_id, version, commit_ts, coalesce(operation, 'UNKNOWN') AS operation, "
    "1 + event_id % 3 AS add_actions, event_id % 2 AS remove_actions, position FROM (SELECT *, "
    "row_number() OVER (PARTITION BY table_id ORDER BY version DESC) AS position FROM commit_log) "
    "WHERE position <= 10",
    C,
)
def commit_log_tail(spark, sf_dir):
    tail = commits.commit_tail(commit_rows(spark, sf_dir), 10)
    return tail.select(
        "table_id", "version", "commit_ts", "operation", "add_actions", "remove_actions", "position"
    )


BUSY = "SELECT user_id % 3 AS table_id, event_id AS version, ts AS commit_ts, event_type AS operation FROM events"


@query(
    "commit_log_long_tail",
    "SELECT table_id, version, operation, position FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY version DESC) "
    f"AS position FROM (SELECT CASE WHEN table_id = 0 THEN 'quiet' ELSE 'busy' END AS table_id, version, operation FROM ({BUSY}))) "
    "WHERE position <= 5000",
)
def commit_log_long_tail(spark, sf_dir):
    """The newest 5000 commits of two tables, one of which has two thirds of all commits."""
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 3 == 0, "quiet").otherwise("busy").alias("table_id"),
        F.col("event_id").cast("bigint").alias("version"), F.lpad("event_id", 20, "0").alias("file_name"),
        F.col("event_type").alias("operation"),
    )
    return commits.commit_tail(rows, 5000).select("table_id", "version", "operation", "position")


@query(
    "commit_tail_summary",
    "SELECT table_id, max(total) AS total_commits, count(*) AS inspected_commits, "
    "sum(1 + event_id % 3) AS added_files, sum(event_id % 2) AS removed_files FROM (SELECT *, "
    "row_number() OVER (PARTITION BY table_id ORDER BY version DESC) AS position, "
    "count(*) OVER (PARTITION BY table_id) AS total FROM commit_log) WHERE position <= 10 GROUP BY table_id",
    C,
    longs=("added_files", "removed_files"),
)
def commit_tail_summary(spark, sf_dir):
    summary = commits.tail_summary(commit_rows(spark, sf_dir), 10)
    return summary.select("table_id", "total_commits", "inspected_commits", "added_files", "removed_files")


@query(
    "sequence_gaps",
    "SELECT table_id, before + 1 AS gap_start, version - 1 AS gap_end, version - before - 1 AS missing FROM "
    "(SELECT table_id, version, lag(version) OVER (PARTITION BY table_id ORDER BY version) AS before "
    "FROM commit_log) WHERE version - before > 1",
    C,
)
def sequence_gaps(spark, sf_dir):
    return sequence.gaps(view(spark, sf_dir, "commit_log"), ["table_id"], "version")


@query(
    "sequence_continuity",
    "SELECT table_id, min(version) AS first_number, max(version) AS last_number, count(*) AS members, "
    "max(version) - min(version) + 1 = count(*) AS is_continuous FROM commit_log GROUP BY table_id",
    C,
)
def sequence_continuity(spark, sf_dir):
    return sequence.continuity(view(spark, sf_dir, "commit_log"), ["table_id"], "version")


@query(
    "monotonic_time",
    "SELECT table_id, before_version AS prev_version, version AS next_version, before AS prev_commit_ts, "
    "commit_ts AS next_commit_ts FROM (SELECT table_id, version, commit_ts, "
    "lag(version) OVER w AS before_version, lag(commit_ts) OVER w AS before FROM commit_log "
    "WHERE commit_ts IS NOT NULL WINDOW w AS (PARTITION BY table_id ORDER BY version)) WHERE commit_ts < before",
    C,
)
def monotonic_time(spark, sf_dir):
    """Every place where the commit time of a table goes backwards."""
    return sequence.setbacks(view(spark, sf_dir, "commit_log"), ["table_id"], "version", "commit_ts")


def table_evidence(spark, sf_dir):
    asked = view(spark, sf_dir, "commit_log").select("table_id").distinct()
    return audits.log_evidence(asked, commits.table_rollup(commit_rows(spark, sf_dir)))


LOG_FINDINGS = (
    "SELECT table_id, 'DLT_SEQ_001' AS code, CASE WHEN is_continuous THEN 'INFO' ELSE 'CRITICAL_FATAL' END "
    f"AS severity, is_continuous AS passed FROM ({TABLE_FACTS}) WHERE unreadable_lines = 0 UNION ALL "
    "SELECT table_id, 'DLT_TIME_002', CASE WHEN time_setbacks = 0 THEN 'INFO' ELSE 'ERROR' END, "
    f"time_setbacks = 0 FROM ({TABLE_FACTS}) WHERE unreadable_lines = 0 UNION ALL "
    f"SELECT table_id, 'DLT_ERR', 'ERROR', false FROM ({TABLE_FACTS}) WHERE unreadable_lines > 0 UNION ALL "
    "SELECT table_id, 'CFR_11_10_E_DELTA', 'WARNING', commits_without_operation = 0 "
    f"FROM ({TABLE_FACTS}) WHERE unreadable_lines = 0"
)


@query("commit_log_findings", LOG_FINDINGS, C)
def commit_log_findings(spark, sf_dir):
    rows = checks.findings(table_evidence(spark, sf_dir), ["table_id"], audits.commit_log_checks())
    return rows.select("table_id", "code", "severity", "passed")


MISSING = (
    "CASE WHEN table_id NOT LIKE '%/measurement' OR has_full_schema THEN '' "
    f"WHEN has_later_schema THEN '{','.join(MEASUREMENT_COLUMNS[2:])}' "
    f"ELSE '{','.join(c for c in MEASUREMENT_COLUMNS if c != 'person_id')}' END"
)


@query(
    "schema_findings",
    "SELECT table_id, 'SCH_001' AS code, CASE WHEN missing = '' THEN 'INFO' ELSE 'CRITICAL_FATAL' END AS severity, "
    "missing = '' AS passed, missing AS missing_columns "
    f"FROM (SELECT table_id, {MISSING} AS missing FROM ({TABLE_FACTS}))",
    C,
)
def schema_findings(spark, sf_dir):
    rows = checks.findings(
        table_evidence(spark, sf_dir), ["table_id"], audits.schema_checks(audits.expected_columns())
    )
    return rows.select(
        "table_id", "code", "severity", "passed", F.col("details")["missing_columns"].alias("missing_columns")
    )


# -- run ledger ---------------------------------------------------------------------


def ledger_rows(spark, sf_dir, deal=False):
    """The runs in the form of the ledger; every ninth experiment names no target schema."""
    runs = view(spark, sf_dir, "run_ledger", deal)
    params = {
        "data_sha256": F.col("data_sha256"),
        "rules_sha256": F.col("rules_sha256"),
        "execution_environment": F.col("execution_environment"),
        "compliance_standard": F.lit("FDA_21_CFR_Part_11"),
        "target_schema": F.when(F.col("experiment_id") % 9 != 0, "OMOP_CDM_v5.4"),
    }
    pairs = [x for name, value in params.items() for x in (F.lit(name), value)]
    metrics = F.create_map(F.lit("gxp_gate_passed"), F.col("gxp_gate_passed").cast("double"))
    return runs.select(
        "run_id",
        F.concat(F.lit("experiment_"), "experiment_id").alias("experiment"),
        F.lit("gate").alias("run_name"),
        F.lit("FINISHED").alias("status"),
        F.col("start_time").cast("timestamp").alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
        F.create_map(*pairs).alias("params"),
        metrics.alias("metrics"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.array(F.lit("rules.json")).alias("artifacts"),
    )


@query(
    "run_ledger",
    "SELECT run_id, concat('experiment_', experiment_id) AS experiment, start_time, data_sha256, rules_sha256, "
    "gxp_gate_passed = 1.0 AS gxp_gate_passed, 0.0::DOUBLE AS expectation_success_rate FROM run_ledger",
    R,
)
def run_ledger(spark, sf_dir):
    """Append all runs to a ledger table and read their state back."""
    path = scratch_path(spark, "ledger")
    ledger.append_runs(ledger_rows(spark, sf_dir), path)
    state = ledger.run_state(ledger.read_ledger(spark, path))
    return plain(
        state.select(
            "run_id", "experiment", "start_time", F.col("params")["data_sha256"].alias("data_sha256"),
            F.col("params")["rules_sha256"].alias("rules_sha256"), "gxp_gate_passed",
            "expectation_success_rate",
        )
    )


@query(
    "latest_run",
    "SELECT experiment, run_id, start_time FROM (SELECT concat('experiment_', experiment_id) AS experiment, "
    "run_id, start_time, row_number() OVER (PARTITION BY experiment_id ORDER BY start_time DESC, run_id DESC) "
    "AS n FROM run_ledger) WHERE n = 1",
    R,
)
def latest_run(spark, sf_dir):
    newest = ledger.latest_run(ledger_rows(spark, sf_dir))
    return plain(newest.select("experiment", "run_id", "start_time"))


@query(
    "experiment_state",
    "SELECT concat(CASE WHEN c_custkey % 4 = 1 THEN 'unknown_' ELSE 'experiment_' END, c_custkey) AS experiment, r.run_id, "
    "CASE WHEN r.run_id IS NULL THEN 'NO_RUNS' ELSE 'FINISHED' END AS status, "
    "coalesce(r.gxp_gate_passed = 1.0, false) AS gxp_gate_passed FROM customer LEFT JOIN "
    "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY start_time DESC, "
    "run_id DESC) AS n FROM run_ledger) WHERE n = 1) r ON c_custkey = r.experiment_id AND c_custkey % 4 <> 1",
    R,
)
def experiment_state(spark, sf_dir):
    """Newest run of one experiment per customer; every fourth one asks for a name that the ledger does not have."""
    unknown = F.when(F.col("c_custkey") % 4 == 1, "unknown_").otherwise("experiment_")
    asked = table(spark, sf_dir, "customer").select(F.concat(unknown, "c_custkey").alias("experiment"))
    state = ledger.experiment_state(asked, ledger_rows(spark, sf_dir))
    return state.select("experiment", "run_id", "status", "gxp_gate_passed")


def requested_runs(spark, sf_dir):
    """Runs that line items point to; about half of them are not in the ledger."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("run_"), F.col("l_orderkey") * 2).alias("run_id")
    )


REQUESTED = "SELECT DISTINCT concat('run_', l_orderkey * 2) AS run_id FROM lineitem"


@query(
    "run_evidence",
    "SELECT q.run_id, CASE WHEN r.run_id IS NULL THEN 'MLF_ERR' ELSE 'MLF_001' END AS code, "
    "CASE WHEN r.run_id IS NULL THEN 'CRITICAL_FATAL' ELSE 'INFO' END AS severity, r.run_id IS NOT NULL AS passed "
    f"FROM ({REQUESTED}) q LEFT JOIN run_ledger r ON q.run_id = r.run_id",
    R,
)
def run_evidence(spark, sf_dir):
    evidence = ledger.run_evidence(requested_runs(spark, sf_dir), ledger_rows(spark, sf_dir))
    rows = checks.findings(evidence, ["run_id"], audits.run_lookup_checks())
    return rows.select("run_id", "code", "severity", "passed")


DATA_OK = "coalesce(regexp_full_match(trim(data_sha256), '[a-fA-F0-9]{64}') OR data_sha256 = 'in_memory_dataframe', false)"
RULES_OK = "coalesce(regexp_full_match(trim(rules_sha256), '[a-fA-F0-9]{64}'), false)"
GATE_OK = "gxp_gate_passed = 1.0"
CONFIG_OK = "experiment_id % 9 <> 0"
RUN_FACTS = (
    f"SELECT run_id, {DATA_OK} AS data_ok, {RULES_OK} AS rules_ok, {GATE_OK} AS gate_ok, "
    f"{CONFIG_OK} AS config_ok FROM run_ledger"
)
RUN_FINDINGS = " UNION ALL ".join(
    f"SELECT run_id, '{code}' AS code, '{severity}' AS severity, {passed} AS passed FROM ({RUN_FACTS})"
    for code, severity, passed in (
        ("CFR_11_10_E_DATA", "CRITICAL_FATAL", "data_ok"),
        ("CFR_11_10_E_RULES", "CRITICAL_FATAL", "rules_ok"),
        ("CFR_11_10_A_VALIDATION", "CRITICAL_FATAL", "gate_ok"),
        ("CFR_11_10_K_CONFIG", "WARNING", "config_ok"),
    )
)


def run_facts(spark, sf_dir, deal=False):
    return ledger_rows(spark, sf_dir, deal).withColumn("run_evidence", F.lit("COLLECTED"))


@query("run_findings", RUN_FINDINGS, R)
def run_findings(spark, sf_dir):
    rows = checks.findings(run_facts(spark, sf_dir), ["run_id"], audits.part_11_checks())
    return rows.select("run_id", "code", "severity", "passed")


# -- scores and reports --------------------------------------------------------------

SCORED = (
    "SELECT *, CASE WHEN critical_failures > 0 OR error_failures > 0 OR compliance_score < 75 THEN 'NON_COMPLIANT' "
    "WHEN warning_failures > 0 OR compliance_score < 95 THEN 'FLAGGED_FOR_REVIEW' ELSE 'COMPLIANT' END "
    "AS compliance_status FROM (SELECT subject, count(*) AS total_evaluations, "
    "count_if(passed) AS passed_evaluations, "
    "count_if(NOT passed AND severity = 'CRITICAL_FATAL') AS critical_failures, "
    "count_if(NOT passed AND severity = 'ERROR') AS error_failures, "
    "count_if(NOT passed AND severity = 'WARNING') AS warning_failures, "
    "greatest(0.0, least(100.0, 100.0 - sum(CASE WHEN passed THEN 0.0 WHEN severity = 'CRITICAL_FATAL' THEN 40.0 "
    "WHEN severity = 'ERROR' THEN 20.0 WHEN severity = 'WARNING' THEN 5.0 WHEN severity = 'INFO' THEN 0.0 "
    "ELSE 10.0 END)))::DOUBLE AS compliance_score FROM ({findings}) GROUP BY subject)"
)
LOG_AND_RUN = (
    f"SELECT table_id AS subject, severity, passed FROM ({LOG_FINDINGS}) UNION ALL "
    f"SELECT run_id AS subject, severity, passed FROM ({RUN_FINDINGS})"
)


def all_findings(spark, sf_dir):
    logs = commit_log_findings(spark, sf_dir).withColumnRenamed("table_id", "subject")
    runs = run_findings(spark, sf_dir).withColumnRenamed("run_id", "subject")
    return logs.unionByName(runs)


@query("compliance_score", SCORED.format(findings=LOG_AND_RUN), C + R, longs=("passed_evaluations", "critical_failures", "error_failures", "warning_failures"))
def compliance_score(spark, sf_dir):
    """Scores from a table of findings of any origin."""
    return checks.score_findings(all_findings(spark, sf_dir), ["subject"])


@query(
    "compliance_summary",
    "SELECT compliance_status, count(*) AS subjects, sum(total_evaluations) AS total_evaluations, "
    "sum(passed_evaluations) AS passed_evaluations, sum(critical_failures) AS critical_failures, "
    "sum(error_failures) AS error_failures, sum(warning_failures) AS warning_failures "
    f"FROM ({SCORED.format(findings=LOG_AND_RUN)}) GROUP BY compliance_status",
    C + R,
    longs=("total_evaluations", "passed_evaluations", "critical_failures", "error_failures", "warning_failures"),
)
def compliance_summary(spark, sf_dir):
    scored = compliance_score(spark, sf_dir)
    counts = (
        "total_evaluations", "passed_evaluations", "critical_failures", "error_failures", "warning_failures"
    )
    return scored.groupBy("compliance_status").agg(
        F.count("*").alias("subjects"), *[F.sum(c).alias(c) for c in counts]
    )


RUN_SCORED = SCORED.format(findings=f"SELECT run_id AS subject, severity, passed FROM ({RUN_FINDINGS})")


@query(
    "compliance_status",
    f"SELECT subject AS run_id, compliance_score, compliance_status, critical_failures, warning_failures FROM ({RUN_SCORED})",
    R,
    longs=("critical_failures", "warning_failures"),
)
def compliance_status(spark, sf_dir):
    """Score and status of every run in one projection, without a shuffle."""
    assessed = checks.assess(run_facts(spark, sf_dir), audits.part_11_checks())
    return assessed.select(
        "run_id", "compliance_score", "compliance_status", "critical_failures", "warning_failures"
    )


def _finding_sql(code: str, severity: str, title: str, passed: str, details: str) -> str:
    good, bad = audits.WORDING[code]
    return (
        f"""'{{"category":"CFR_PART_11","code":"{code}","description":"' || CASE WHEN {passed} THEN '{good}' ELSE '{bad}' END """
        f"""|| '","details":{{' || {details} || '}},"passed":' || CASE WHEN {passed} THEN 'true' ELSE 'false' END """
        f"""|| ',"severity":"{severity}","title":"{title}"}}'"""
    )


def report_sql() -> str:
    """The whole report document, written out in SQL."""
    listed = [
        _finding_sql(
            "CFR_11_10_A_VALIDATION", "CRITICAL_FATAL", "Contract gate passed without a failed rule", "gate_ok",
            """'"gxp_gate_passed":"' || CASE WHEN gate_ok THEN '1.0' ELSE '0.0' END || """
            """'","unsuccessful_expectations":"0.0"'""",
        ),
        _finding_sql(
            "CFR_11_10_E_DATA", "CRITICAL_FATAL", "Source data carry a SHA-256 digest", "data_ok",
            """'"data_sha256":"' || coalesce(data_sha256, '') || '","in_memory":"' || """
            """CASE WHEN data_sha256 = 'in_memory_dataframe' THEN 'true' ELSE 'false' END || '"'""",
        ),
        _finding_sql(
            "CFR_11_10_E_RULES", "CRITICAL_FATAL", "Contract rules carry a SHA-256 digest", "rules_ok",
            """'"rules_sha256":"' || rules_sha256 || '"'""",
        ),
        _finding_sql(
            "CFR_11_10_K_CONFIG", "WARNING", "Standard, target schema and environment declared", "config_ok",
            """'"compliance_standard":"FDA_21_CFR_Part_11","execution_environment":"' || execution_environment """
            """|| '","target_schema":"' || CASE WHEN config_ok THEN 'OMOP_CDM_v5.4' ELSE '' END || '"'""",
        ),
    ]
    return (
        f"""'{{"audit_timestamp":"{NOW}","compliance_score":' || printf('%.2f', compliance_score) || ',"compliance_status":"' """
        """|| compliance_status || '","evidence_summary":{"log":"SKIPPED","run":"COLLECTED","schema":"SKIPPED"},"findings":[' || """
        + " || ',' || ".join(listed)
        + f""" || '],"regulatory_standard":"{fixed.REGULATORY_STANDARD}","summary":{{"critical_failures":' || critical_failures """
        """|| ',"error_failures":' || error_failures || ',"passed_evaluations":' || passed_evaluations """
        """|| ',"total_evaluations":' || total_evaluations || ',"warning_failures":' || warning_failures """
        f"""|| '}},"target_framework":"{fixed.TARGET_FRAMEWORK}","target_identifiers":{{"rules_path":"{RULES_PATH}","run_id":"' """
        """|| f.run_id || '"}}'"""
    )


RULES_PATH = "rules/person.json"
REPORT_ROWS = (
    f"(SELECT f.run_id, compliance_score, compliance_status, {report_sql()} AS report_json FROM "
    f"(SELECT run_id, data_sha256, rules_sha256, execution_environment, {DATA_OK} AS data_ok, "
    f"{RULES_OK} AS rules_ok, {GATE_OK} AS gate_ok, {CONFIG_OK} AS config_ok FROM run_ledger) f "
    f"JOIN ({RUN_SCORED}) s ON f.run_id = s.subject)"
)


def run_reports(spark, sf_dir):
    assessed = checks.assess(run_facts(spark, sf_dir, deal=True), audits.part_11_checks())
    return checks.report(assessed.withColumn("rules_path", F.lit(RULES_PATH)), ["run_id", "rules_path"], NOW)


@query(
    "audit_receipt",
    f"SELECT run_id, compliance_status, report_json, sha256(report_json) AS receipt_sha256 FROM {REPORT_ROWS}",
    R,
)
def audit_receipt(spark, sf_dir):
    """Report documents and their receipts, byte for byte."""
    return run_reports(spark, sf_dir).select("run_id", "compliance_status", "report_json", "receipt_sha256")


@query(
    "audit_certificates",
    "SELECT run_id, compliance_status AS gxp_audit_status, sha256(report_json) AS gxp_audit_receipt_sha256, "
    f"compliance_score AS gxp_audit_compliance_score FROM {REPORT_ROWS}",
    R,
)
def audit_certificates(spark, sf_dir):
    """What an audit attaches to its run: tags and metrics, here as columns."""
    given = checks.certificates(run_reports(spark, sf_dir))
    return given.select(
        "run_id", F.col("tags")["gxp_audit_status"].alias("gxp_audit_status"),
        F.col("tags")["gxp_audit_receipt_sha256"].alias("gxp_audit_receipt_sha256"),
        F.col("metrics")["gxp_audit_compliance_score"].alias("gxp_audit_compliance_score"),
    )


@query(
    "audit_report_json",
    "SELECT run_id, compliance_status, sha256(report_json) AS document_sha256, '2024-06-01' AS audit_date "
    f"FROM {REPORT_ROWS}",
    R,
)
def audit_report_json(spark, sf_dir):
    """Write the reports as JSON by audit date and read the documents back."""
    path = scratch_path(spark, "reports")
    write_reports(run_reports(spark, sf_dir), path)
    written = spark.read.text(path)
    return written.select(
        F.get_json_object("value", "$.target_identifiers.run_id").alias("run_id"),
        F.get_json_object("value", "$.compliance_status").alias("compliance_status"),
        F.sha2("value", 256).alias("document_sha256"),
        F.col("audit_date").cast("string").alias("audit_date"),
    )


DECISION = "CASE WHEN n % 3 = 0 THEN 'OVERRIDE' WHEN n % 3 = 1 THEN 'REJECTED' END"
SIGNOFFS = (
    "SELECT concat('run_', l_orderkey) AS run_id, l_shipdate AS ship, l_suppkey AS n FROM lineitem"
)


def signoffs(spark, sf_dir):
    """Sign-offs by line item: several per run, of which the newest counts."""
    line = table(spark, sf_dir, "lineitem")
    n = F.col("l_suppkey")
    return line.select(
        F.concat(F.lit("run_"), "l_orderkey").alias("run_id"),
        F.concat(F.lit("operator_"), F.lpad(n.cast("string"), 9, "0")).alias("operator_id"),
        F.when(n % 3 == 0, "OVERRIDE").when(n % 3 == 1, "REJECTED").alias("decision"),
        F.when(n % 2 == 0, "checked by hand").alias("justification"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("timestamp"),
        F.lit(None).cast("string").alias("signature_checksum"),
    )


@query(
    "audit_signoff",
    "SELECT s.subject AS run_id, CASE WHEN s.compliance_status = 'COMPLIANT' OR g.run_id IS NULL "
    "THEN s.compliance_status WHEN g.decision = 'OVERRIDE' THEN 'APPROVED_BY_QA' ELSE 'REJECTED_BY_QA' END "
    "AS compliance_status, s.compliance_status <> 'COMPLIANT' AND g.run_id IS NULL AS awaiting_signoff, "
    "CASE WHEN s.compliance_status <> 'COMPLIANT' AND g.run_id IS NOT NULL THEN sha256(concat_ws(':', "
    "g.operator_id, coalesce(g.decision, 'REJECTED'), coalesce(g.justification, 'No justification provided'), g.given_at)) "
    f"END AS signature FROM ({RUN_SCORED}) s LEFT JOIN (SELECT * FROM (SELECT run_id, operator_id, decision, "
    "justification, given_at, row_number() OVER (PARTITION BY run_id ORDER BY given_at DESC, operator_id DESC, "
    "decision DESC NULLS LAST, justification DESC NULLS LAST) AS rank FROM (SELECT run_id, "
    "concat('operator_', lpad(CAST(n AS VARCHAR), 9, '0')) AS operator_id, "
    f"{DECISION} AS decision, CASE WHEN n % 2 = 0 THEN 'checked by hand' END AS justification, "
    f"strftime(ship, '%Y-%m-%d') AS given_at FROM ({SIGNOFFS}))) WHERE rank = 1) g ON s.subject = g.run_id",
    R,
)
def audit_signoff(spark, sf_dir):
    signed = checks.sign_off(
        run_reports(spark, sf_dir), signoffs(spark, sf_dir), "run_id", ["run_id"], NOW
    )
    return signed.select(
        "run_id", "compliance_status", "awaiting_signoff",
        F.col("qa_signoff.signature_checksum").alias("signature"),
    )


# -- many audits at once -------------------------------------------------------------

AUDIT_TARGETS = {
    "audit_id": "CAST(o_orderkey AS string)",
    "run_id": "CASE WHEN o_orderkey % 3 <> 0 THEN concat('run_', o_orderkey * 2) END",
    "table_id": (
        "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'lake/person' WHEN 2 THEN 'lake/nowhere' "
        "ELSE concat('lake/', CAST(2 * (o_orderkey % 40) AS string), '/measurement') END"
    ),
    "log_exists": "o_orderkey % 4 <> 2",
}
TARGETS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in AUDIT_TARGETS.items()) + " FROM orders"


def audit_targets(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in AUDIT_TARGETS.items()])


_TARGET_FINDINGS = (
    "SELECT audit_id AS subject, 'CRITICAL_FATAL' AS severity, false AS passed FROM targets t "
    "WHERE run_id IS NOT NULL AND run_id NOT IN (SELECT run_id FROM run_ledger) UNION ALL "
    "SELECT audit_id, 'INFO', true FROM targets WHERE run_id IS NULL OR run_id IN (SELECT run_id FROM run_ledger) "
    f"UNION ALL SELECT t.audit_id, f.severity, f.passed FROM targets t JOIN ({RUN_FINDINGS}) f ON t.run_id = f.run_id "
    f"UNION ALL SELECT t.audit_id, f.severity, f.passed FROM targets t JOIN ({LOG_FINDINGS}) f ON t.table_id = f.table_id "
    "UNION ALL SELECT audit_id, 'CRITICAL_FATAL', false FROM targets "
    "WHERE table_id IS NOT NULL AND table_id NOT IN (SELECT table_id FROM commit_log) UNION ALL "
    "SELECT audit_id, 'INFO', true FROM targets "
    "WHERE table_id IS NULL OR table_id NOT IN (SELECT table_id FROM commit_log) UNION ALL "
    "SELECT t.audit_id, CASE WHEN missing = '' THEN 'INFO' ELSE 'CRITICAL_FATAL' END, missing = '' FROM targets t "
    f"JOIN (SELECT table_id, {MISSING} AS missing FROM ({TABLE_FACTS})) m ON t.table_id = m.table_id"
)


@query(
    "audit_report",
    "SELECT subject AS audit_id, total_evaluations, passed_evaluations, critical_failures, error_failures, "
    "warning_failures, compliance_score, compliance_status FROM ("
    + SCORED.format(findings=_TARGET_FINDINGS.replace("targets", f"({TARGETS_SQL})"))
    + ")",
    C + R,
    longs=("passed_evaluations", "critical_failures", "error_failures", "warning_failures"),
)
def audit_report(spark, sf_dir):
    """One audit per order, over a run, a table, both or neither; a quarter share one table."""
    reports = audit_job.audit(
        audit_targets(spark, sf_dir), ledger_rows(spark, sf_dir), actions(spark, sf_dir), NOW
    )
    return reports.select(
        "audit_id", "total_evaluations", "passed_evaluations", "critical_failures", "error_failures",
        "warning_failures", "compliance_score", "compliance_status",
    )
