"""Contract evaluation and row violations."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clinlake.fixed_values import RULE_COLUMNS, RULE_IN_SET, RULE_NOT_NULL, RULE_REGEX
from clinlake.operators import contracts
from clinlake.sources.contracts import contract_of, load_contract

PERSON = (
    "person_id bigint, gender_concept_id int, year_of_birth int, birth_datetime string, race_concept_id int, "
    "ethnicity_concept_id int"
)


def person(spark, *data):
    return spark.createDataFrame(list(data), PERSON)


def contract(*entries):
    return contract_of({"expectations": [{"expectation_type": k, "kwargs": kw} for k, kw in entries]})


GOOD = [
    (55, 8532, 2004, "2004-07-30T01:02:03Z", 8516, 38003563),
    (56, 8507, 1951, "1951-02-09T23:41:10Z", 8515, 38003564),
]


def test_valid_data_pass_all_rules(spark):
    gate = contracts.run_gate(person(spark, *GOOD), load_contract(spark), strict=True)
    assert gate.success and gate.evaluated_expectations == 4 and gate.success_rate == 100.0
    assert gate.total_records == 2


def test_strict_gate_raises_with_the_failed_rules(spark):
    bad = person(spark, (None, *GOOD[0][1:]), GOOD[1])
    gate = contracts.run_gate(bad, load_contract(spark))
    assert not gate.success and gate.unsuccessful_expectations == 1 and gate.success_rate == 75.0
    with pytest.raises(contracts.ContractBreach, match="person_id"):
        contracts.run_gate(bad, load_contract(spark), strict=True)


def test_the_gate_sees_every_row(spark):
    bad_last = spark.range(25_000).select(
        F.when(F.col("id") != 24_999, F.col("id")).alias("person_id")
    )
    assert not contracts.run_gate(bad_last, contract((RULE_NOT_NULL, {"column": "person_id"}))).success


def test_temporal_columns_are_read_as_iso_text(spark):
    df = spark.createDataFrame([(datetime(1985, 6, 15, 8, 30), date(1985, 6, 15))], "t timestamp, d date")
    rules = contract(
        (RULE_REGEX, {"column": "t", "regex": r"^1985-06-15T08:30:00Z$"}),
        (RULE_REGEX, {"column": "d", "regex": r"^1985-06-15$"}),
    )
    assert contracts.run_gate(df, rules).success


def test_null_breaks_only_the_not_null_rule(spark):
    df = spark.createDataFrame([(None,), ("x",)], "c string")
    rules = contract(
        (RULE_REGEX, {"column": "c", "regex": "^x$"}), (RULE_IN_SET, {"column": "c", "value_set": ["x"]}),
        (RULE_NOT_NULL, {"column": "c"}),
    )
    got = contracts.rule_results(df, rules).orderBy("position").collect()
    assert [r["success"] for r in got] == [True, True, False]
    assert [r["evaluated_rows"] for r in got] == [1, 1, 2]


def test_sets_compare_numbers_and_text(spark):
    df = spark.createDataFrame([(8507, "8507"), (0, "0")], "n int, s string")
    rules = contract(*[(RULE_IN_SET, {"column": c, "value_set": [8507, 0]}) for c in ("n", "s")])
    assert contracts.run_gate(df, rules).success


def test_column_sets(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    for columns, exact, ok in ((["a"], False, True), (["a"], True, False), (["a", "b"], True, True), (["a", "c"], False, False)):
        rules = contract((RULE_COLUMNS, {"column_set": columns, "exact_match": exact}))
        assert contracts.run_gate(df, rules).success is ok


def test_unknown_rules_are_skipped_and_missing_columns_fail(spark):
    df = spark.createDataFrame([(1,)], "a int")
    rules = contract(("expect_something_else", {"column": "a"}), (RULE_NOT_NULL, {"column": "zz"}))
    got = contracts.rule_results(df, rules).orderBy("position").collect()
    assert [r["status"] for r in got] == ["SKIPPED", "MISSING_COLUMN"]
    assert contracts.run_gate(df, rules).evaluated_expectations == 1


def test_nothing_evaluated_gives_a_rate_of_zero(spark):
    df = spark.createDataFrame([(1,)], "a int")
    for rules in (contract(), contract(("expect_x", {}))):
        summary = contracts.summarise(contracts.rule_results(df, rules)).first()
        assert summary["success_rate"] == 0.0 and summary["evaluated_expectations"] == 0
        assert contracts.run_gate(df, rules).success_rate == 0.0


def test_empty_table_passes(spark):
    assert contracts.run_gate(person(spark), load_contract(spark)).success


def test_one_scan_serves_all_rules(spark):
    path_plan = contracts.rule_results(
        spark.read.parquet("/root/testdata/sf0.001/customer.parquet"),
        contract(
            (RULE_NOT_NULL, {"column": "c_name"}), (RULE_REGEX, {"column": "c_name", "regex": "C"}),
            (RULE_IN_SET, {"column": "c_nationkey", "value_set": [1]}),
        ),
    )._jdf.queryExecution().executedPlan().toString()
    assert path_plan.count("FileScan parquet") == 1 and "c_acctbal" not in path_plan


def test_row_violations(spark):
    rules = load_contract(spark)
    bad = person(spark, (None, 9999, 1985, "June 15", 8527, 1), GOOD[0], (5, None, None, None, 1, 1))
    marked = contracts.with_violations(bad, rules)
    by_id = {r["person_id"]: r for r in marked.collect()}
    assert [v["expectation_type"] for v in by_id[None]["violations"]] == [RULE_NOT_NULL, RULE_REGEX, RULE_IN_SET]
    assert by_id[None]["violations"][0]["severity"] == "CRITICAL_FATAL"
    assert by_id[55]["valid"] and by_id[5]["valid"]
    assert contracts.violations(bad, rules, ["person_id"]).count() == 3


def test_row_patterns_match_from_the_start(spark):
    df = spark.createDataFrame([("xa",), ("ab",)], "c string")
    rules = contract((RULE_REGEX, {"column": "c", "regex": "a|zz"}))
    assert [r["c"] for r in contracts.with_violations(df, rules).where("NOT valid").collect()] == ["xa"]


def test_missing_columns_are_row_violations(spark):
    df = spark.createDataFrame([(1,)], "a int")
    got = contracts.with_violations(df, contract((RULE_REGEX, {"column": "zz", "regex": "x"}))).first()
    assert not got["valid"] and got["violations"][0]["message"] == "zz is missing"
    assert contracts.with_violations(df, contract()).first()["valid"]
