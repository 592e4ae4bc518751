"""Clinical source tables derived from the given tables, row by row.

Each view is a base table and one SQL expression per column that Spark and DuckDB
read alike (two spellings differ, see ``in_spark_sql``). None needs a
join, a window or a row limit.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "bronze_patients": (
        "customer",
        {
            "raw_patient_id": "concat('PAT_', c_custkey)",
            "gender": (
                "CASE c_custkey % 8 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' WHEN 2 THEN ' m ' "
                "WHEN 3 THEN 'F' WHEN 4 THEN 'UNKNOWN' WHEN 5 THEN 'INVALID' WHEN 6 THEN NULL "
                "ELSE 'Male' END"
            ),
            "birth_datetime": (
                "CASE WHEN c_custkey % 11 = 0 THEN '13th of Smarch' "
                "WHEN c_custkey % 11 = 1 THEN '1985-06-15' "
                "ELSE concat(CAST(1940 + c_custkey % 65 AS string), '-', "
                "lpad(CAST(1 + c_custkey % 12 AS string), 2, '0'), '-', "
                "lpad(CAST(1 + c_custkey % 28 AS string), 2, '0'), ' 08:30:00') END"
            ),
            "race": (
                "CASE c_nationkey % 4 WHEN 0 THEN 'WHITE' WHEN 1 THEN 'asian' "
                "WHEN 2 THEN 'BLACK' ELSE 'OTHER' END"
            ),
            "ethnicity": (
                "CASE c_custkey % 3 WHEN 0 THEN 'HISPANIC' WHEN 1 THEN 'NOT_HISPANIC' "
                "ELSE 'NON_HISPANIC' END"
            ),
        },
    ),
    "bronze_diagnoses": (
        "orders",
        {
            "encounter_id": "concat('ENC_', o_orderkey)",
            "raw_patient_id": "concat('PAT_', o_custkey)",
            "diagnosis_date": (
                "CASE WHEN o_orderkey % 13 = 0 THEN 'bad-date' "
                "ELSE concat(CAST(CAST(o_orderdate AS date) AS string), ' 10:30:00') END"
            ),
            "icd10_code": (
                "CASE o_orderkey % 7 WHEN 0 THEN 'E11.9' WHEN 1 THEN 'e119' WHEN 2 THEN ' I10' "
                "WHEN 3 THEN 'J45.909' WHEN 4 THEN 'I21.9' WHEN 5 THEN 'C34.90' ELSE 'Z00.00' END"
            ),
            "diagnosis_description": "o_orderpriority",
        },
    ),
    "bronze_labs": (
        "lineitem",
        {
            "lab_event_id": (
                "concat('LAB_', l_orderkey, '_', l_partkey, '_', l_suppkey, '_', l_linenumber)"
            ),
            "raw_patient_id": "concat('PAT_', l_partkey)",
            "lab_datetime": (
                "CASE WHEN l_suppkey % 17 = 0 THEN 'n/a' "
                "WHEN l_suppkey % 17 = 1 THEN CAST(CAST(l_shipdate AS date) AS string) "
                "ELSE concat(CAST(CAST(l_shipdate AS date) AS string), ' 11:00:00') END"
            ),
            "loinc_code": (
                "CASE l_suppkey % 6 WHEN 0 THEN '4548-4' WHEN 1 THEN '2345-7' "
                "WHEN 2 THEN ' 2093-3' WHEN 3 THEN '2160-0' WHEN 4 THEN '33959-8' "
                "ELSE '9999-9' END"
            ),
            "test_name": "l_returnflag",
            "numeric_value": (
                "CASE WHEN l_linenumber = 7 THEN 'Positive' ELSE CAST(l_quantity AS string) END"
            ),
            "unit_value": "l_linestatus",
        },
    ),
    "bronze_variants": (
        "part",
        {
            "chrom": "concat('chr', 1 + p_partkey % 22)",
            "pos": "CAST(10000 + p_partkey * 37 AS string)",
            "id": "concat('rs', p_partkey)",
            "ref": (
                "CASE p_partkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' ELSE 'T' END"
            ),
            "alt": "CASE p_partkey % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'T' ELSE 'TG' END",
            "qual": "CASE WHEN p_partkey % 10 = 0 THEN '.' ELSE CAST(p_size AS string) END",
            "filter": (
                "CASE p_partkey % 5 WHEN 0 THEN '.' WHEN 1 THEN 'LOW_QUAL' WHEN 2 THEN NULL "
                "ELSE 'PASS' END"
            ),
            "info": (
                "CASE WHEN p_partkey % 9 = 0 THEN 'AF=0.1' ELSE concat('GENE=', p_brand, "
                "';CLNSIG=', CASE p_partkey % 6 WHEN 0 THEN 'Pathogenic' "
                "WHEN 1 THEN 'Likely_pathogenic' WHEN 2 THEN 'Benign' WHEN 3 THEN 'Likely_benign' "
                "WHEN 4 THEN 'Uncertain_significance' ELSE 'Not_provided' END, ';AF=0.01') END"
            ),
            "patient_id": "concat('PAT_', p_partkey)",
            "sample_id": "concat('SAMPLE_', p_partkey % 50)",
        },
    ),
    # One table holds every third event, the others 64 commits each. Some versions and
    # times are disturbed: see the CASE branches.
    "commit_log": (
        "events",
        {
            "table_id": (
                "CASE WHEN event_id % 3 = 0 THEN 'lake/person' "
                "WHEN (event_id // 96) % 2 = 0 "
                "THEN concat('lake/', CAST(event_id // 96 AS string), '/measurement') "
                "ELSE concat('lake/', CAST(event_id // 96 AS string), '/scratch') END"
            ),
            "version": (
                "CASE WHEN event_id % 3 = 0 THEN event_id // 3 "
                "ELSE ((event_id % 96) // 3) * 2 + event_id % 3 - 1 "
                "+ CASE WHEN (event_id // 96) % 5 = 4 AND event_id % 96 > 50 THEN 7 ELSE 0 END END"
            ),
            "commit_ts": (
                "CASE WHEN event_id % 97 = 0 THEN NULL "
                "WHEN (event_id // 96) % 7 = 3 AND event_id % 96 = 40 "
                "THEN 1704000000000 ELSE 1704067200000 + event_id * 1000 END"
            ),
            "operation": "CASE WHEN event_id % 96 = 11 THEN NULL ELSE event_type END",
            "event_id": "event_id",
        },
    ),
    "run_ledger": (
        "orders",
        {
            "run_id": "concat('run_', o_orderkey)",
            "experiment_id": "o_custkey",
            "start_time": "o_orderdate",
            "data_sha256": (
                "CASE o_orderkey % 4 WHEN 0 THEN sha256(CAST(o_orderkey AS string)/*256*/) "
                "WHEN 1 THEN 'in_memory_dataframe' WHEN 2 THEN 'not-a-digest' ELSE NULL END"
            ),
            "rules_sha256": (
                "CASE WHEN o_orderkey % 3 = 0 THEN 'bad' ELSE sha256(o_orderpriority/*256*/) END"
            ),
            "gxp_gate_passed": "CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE 1.0 END",
            "execution_environment": "o_orderstatus",
        },
    ),
}


def in_spark_sql(expression: str) -> str:
    """Spark spelling of an expression: its digest function and integer division."""
    return (
        expression.replace("sha256(", "sha2(").replace("/*256*/", ", 256").replace(" // ", " div ")
    )


def view_sql(name: str) -> str:
    """The view as SQL for the oracle engine."""
    base, columns = VIEWS[name]
    listed = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    return f"SELECT {listed} FROM {base}"


def with_views(sql: str, names: tuple[str, ...]) -> str:
    """Put the views in front of a query (which must not start with WITH itself)."""
    if not names:
        return sql
    ctes = ", ".join(f"{n} AS ({view_sql(n)})" for n in names)
    return f"WITH {ctes} {sql}"
