"""Contracts: single rules, whole suites, summaries and row violations."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from clinlake.fixed_values import RULE_COLUMNS, RULE_IN_SET, RULE_NOT_NULL, RULE_REGEX
from clinlake.operators import contracts, ledger, omop, silver
from clinlake.operators.contracts import ContractBreach
from clinlake.plans import governance_job
from clinlake.sources.contracts import contract_of
from clinlake.workspace import scratch_path
from workload.catalog import query, saved, table, view
from workload.q_columns import P
from workload.q_omop import KEYS, person_columns

PEOPLE = f"({person_columns('bronze_patients')})"
ISO = "strftime(birth_datetime, '%Y-%m-%dT%H:%M:%SZ')"


def rule(kind, severity, **kwargs):
    return {"expectation_type": kind, "kwargs": kwargs, "meta": {"severity": severity}}


NOT_NULL = rule(RULE_NOT_NULL, "CRITICAL_FATAL", column="birth_datetime")
REGEX = rule(RULE_REGEX, "ERROR", column="birth_datetime", regex=r"^19[4-9]\d-\d{2}-\d{2}T")
IN_SET = rule(RULE_IN_SET, "WARNING", column="gender_concept_id", value_set=[8507, 8532])
COLUMNS = rule(RULE_COLUMNS, "CRITICAL_FATAL", column_set=["person_id", "provider_id"], exact_match=False)
MOSTLY = rule(RULE_IN_SET, "WARNING", column="race_concept_id", value_set=[8527, 8515, 8516], mostly=0.5)
ABSENT = rule(RULE_NOT_NULL, "ERROR", column="provider_id")
UNKNOWN = rule("expect_column_mean_to_be_between", "ERROR", column="year_of_birth", min_value=1900)
SUITE = [NOT_NULL, REGEX, IN_SET, COLUMNS, MOSTLY, ABSENT, UNKNOWN]


def contract(*rules):
    return contract_of({"expectation_suite_name": "workload", "expectations": list(rules)})


def everyone(spark, sf_dir):
    """PERSON of all patients, also of those that would be quarantined."""
    return omop.person(silver.parse_patients(view(spark, sf_dir, "bronze_patients")), key_style=KEYS)


def result_sql(position, entry, status, rows, bad, success, details="NULL") -> str:
    column = entry["kwargs"].get("column")
    named = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT count(*) AS total_records, {position} AS position, "
        f"'{entry['expectation_type']}' AS expectation_type, {named} AS column_name, "
        f"'{entry['meta']['severity']}' AS severity, '{status}' AS status, "
        f"CAST({rows} AS BIGINT) AS evaluated_rows, CAST({bad} AS BIGINT) AS unexpected_count, "
        f"{success} AS success, CAST({details} AS VARCHAR) AS details FROM {PEOPLE}"
    )


NULL_BIRTHS = "count_if(birth_datetime IS NULL)"
BAD_BIRTHS = rf"count_if(coalesce(NOT regexp_matches({ISO}, '^19[4-9]\d-\d{{2}}-\d{{2}}T'), false))"
BAD_GENDERS = "count_if(gender_concept_id NOT IN (8507, 8532))"
BAD_RACES = "count_if(race_concept_id NOT IN (8527, 8515, 8516))"


def not_null_sql(i):
    return result_sql(i, NOT_NULL, "EVALUATED", "count(*)", NULL_BIRTHS, f"{NULL_BIRTHS} = 0")


def regex_sql(i):
    return result_sql(i, REGEX, "EVALUATED", "count(birth_datetime)", BAD_BIRTHS, f"{BAD_BIRTHS} = 0")


def in_set_sql(i):
    return result_sql(i, IN_SET, "EVALUATED", "count(gender_concept_id)", BAD_GENDERS, f"{BAD_GENDERS} = 0")


def columns_sql(i):
    return result_sql(i, COLUMNS, "EVALUATED", "count(*)", "1", "false", "'provider_id'")


SUITE_SQL = " UNION ALL ".join(
    [
        not_null_sql(0),
        regex_sql(1),
        in_set_sql(2),
        columns_sql(3),
        result_sql(
            4, MOSTLY, "EVALUATED", "count(race_concept_id)", BAD_RACES,
            f"{BAD_RACES} <= count(race_concept_id) * 0.5",
        ),
        result_sql(5, ABSENT, "MISSING_COLUMN", "0", "0", "false"),
        result_sql(6, UNKNOWN, "SKIPPED", "0", "0", "CAST(NULL AS BOOLEAN)"),
    ]
)


@query("contract_not_null", not_null_sql(0), P)
def contract_not_null(spark, sf_dir):
    return contracts.rule_results(everyone(spark, sf_dir), contract(NOT_NULL))


@query("contract_regex", regex_sql(0), P)
def contract_regex(spark, sf_dir):
    return contracts.rule_results(everyone(spark, sf_dir), contract(REGEX))


@query("contract_in_set", in_set_sql(0), P)
def contract_in_set(spark, sf_dir):
    return contracts.rule_results(everyone(spark, sf_dir), contract(IN_SET))


@query("contract_columns", columns_sql(0), P)
def contract_columns(spark, sf_dir):
    return contracts.rule_results(everyone(spark, sf_dir), contract(COLUMNS))


@query("contract_suite", SUITE_SQL, P)
def contract_suite(spark, sf_dir):
    """All rules at once: one aggregate over the table."""
    return contracts.rule_results(everyone(spark, sf_dir), contract(*SUITE))


@query(
    "contract_summary",
    "SELECT count_if(success) = count(success) AS success, max(total_records) AS total_records, "
    "count(success) AS evaluated_expectations, count_if(success) AS successful_expectations, "
    "count_if(NOT success) AS unsuccessful_expectations, "
    f"count_if(success) / count(success) * 100.0 AS success_rate FROM ({SUITE_SQL})",
    P,
    longs=("successful_expectations", "unsuccessful_expectations"),
)
def contract_summary(spark, sf_dir):
    return contracts.summarise(contract_suite(spark, sf_dir))


@query(
    "row_violations",
    "SELECT person_source_value, 'birth_datetime' AS column_name, "
    f"'{RULE_NOT_NULL}' AS expectation_type, 'CRITICAL_FATAL' AS severity, "
    f"'birth_datetime is null' AS message FROM {PEOPLE} WHERE birth_datetime IS NULL UNION ALL "
    f"SELECT person_source_value, 'birth_datetime', '{RULE_REGEX}', 'ERROR', "
    "concat('birth_datetime = ', strftime(birth_datetime, '%Y-%m-%d %H:%M:%S'), "
    r"' does not match ^19[4-9]\d-\d{2}-\d{2}T') "
    rf"FROM {PEOPLE} WHERE NOT regexp_matches({ISO}, '^19[4-9]\d-\d{{2}}-\d{{2}}T') UNION ALL "
    f"SELECT person_source_value, 'gender_concept_id', '{RULE_IN_SET}', 'WARNING', "
    "concat('gender_concept_id = ', gender_concept_id, ' is not one of [8507, 8532]') "
    f"FROM {PEOPLE} WHERE gender_concept_id NOT IN (8507, 8532) UNION ALL "
    f"SELECT person_source_value, 'provider_id', '{RULE_NOT_NULL}', 'ERROR', 'provider_id is missing' "
    f"FROM {PEOPLE}",
    P,
)
def row_violations(spark, sf_dir):
    rules = contract(NOT_NULL, REGEX, IN_SET, ABSENT, UNKNOWN)
    return contracts.violations(everyone(spark, sf_dir), rules, ["person_source_value"])


# -- whole contract runs ----------------------------------------------------------

GOVERNED_RULES = {
    "expectation_suite_name": "orders",
    "expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "o_orderkey"}},
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "o_orderstatus", "value_set": ["O", "F"]}},
    ],
}
GOVERNED_SQL = (
    "SELECT count(*)::DOUBLE AS total_records_ingested, 2.0::DOUBLE AS evaluated_expectations, "
    "(count(*) = count(o_orderkey))::INT + (count_if(o_orderstatus NOT IN ('O', 'F')) = 0)::INT AS held, "
    "{extra} FROM orders"
)


def governed_file(spark, sf_dir):
    """Orders as CSV files, and the rules for them as a JSON file."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    data = saved(spark, table(spark, sf_dir, "orders").select(*columns), "governed", "csv", header=True)
    document = spark.createDataFrame([(json.dumps(GOVERNED_RULES),)], "value string").coalesce(1)
    return data, saved(spark, document, "rules", "text")


@query(
    "governance_run",
    GOVERNED_SQL.format(extra="'R1' AS run_id, count(o_orderkey) = count(*) AS keys_hold"),
)
def governance_run(spark, sf_dir):
    """Load, evaluate and record; then read the ledger back, with every rule's outcome."""
    data, rules = governed_file(spark, sf_dir)
    path = scratch_path(spark, "ledger")
    governance_job.govern(
        spark, data, rules, ledger_path=path, run_id="R1",
        schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string",
    )
    tags = F.col("tags")
    return ledger.read_ledger(spark, path).select(
        F.col("metrics")["total_records_ingested"].alias("total_records_ingested"),
        F.col("metrics")["evaluated_expectations"].alias("evaluated_expectations"),
        F.size(F.map_filter(tags, lambda _, v: v.endswith(": held"))).alias("held"),
        "run_id",
        (tags["rule_0"] == "expect_column_values_to_not_be_null(o_orderkey): held").alias("keys_hold"),
    )


@query(
    "strict_gate",
    "SELECT count(*) AS rows, count_if(o_orderstatus NOT IN ('O', 'F')) > 0 AS raised FROM orders",
)
def strict_gate(spark, sf_dir):
    """A strict run raises if a rule is broken, after it has judged all rows."""
    data, rules = governed_file(spark, sf_dir)
    raised = False
    try:
        governance_job.govern(
            spark, data, rules, strict=True, schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string"
        )
    except ContractBreach:
        raised = True
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("rows"), F.lit(raised).alias("raised"))
