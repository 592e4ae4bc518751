"""OMOP transforms, gold counts, unions, registry and conformance."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinlake.operators import columns, omop, registry, silver
from clinlake.plans.omop_job import build_omop, gold_tables, parse_sources
from clinlake.plans.omop_job import gold_counts as count_gold
from clinlake.workspace import scratch_path
from workload.catalog import plain, query, table, view
from workload.q_columns import (
    BIRTH, CLINVAR_SQL, CLNSIG_SQL, D, ETHNICITY_SQL, GENDER_SQL, GENE_SQL, ICD10_SQL, L, LAB_TIME,
    LOINC_SQL, P, PATIENT_OK, RACE_SQL, V, sha_key,
)

# The digest style of the keys can be recomputed by the oracle engine.
KEYS = "digest"


def bronze(spark, sf_dir):
    names = ("patients", "diagnoses", "labs", "variants")
    return {n: view(spark, sf_dir, f"bronze_{n}") for n in names}


def gold(spark, sf_dir, key_style=KEYS):
    parsed = parse_sources(bronze(spark, sf_dir))
    accepted = {n: silver.split_rows(df, ok).accepted for n, (df, ok) in parsed.items()}
    return gold_tables(accepted, key_style=key_style)


def person_columns(source: str) -> str:
    return (
        f"SELECT {sha_key('raw_patient_id')} AS person_id, {GENDER_SQL} AS gender_concept_id, "
        f"year({BIRTH}) AS year_of_birth, month({BIRTH}) AS month_of_birth, "
        f"day({BIRTH}) AS day_of_birth, {BIRTH} AS birth_datetime, {RACE_SQL} AS race_concept_id, "
        f"{ETHNICITY_SQL} AS ethnicity_concept_id, raw_patient_id AS person_source_value, "
        "gender AS gender_source_value, race AS race_source_value, "
        f"ethnicity AS ethnicity_source_value FROM {source}"
    )


PERSON_SQL = person_columns("bronze_patients") + f" WHERE {PATIENT_OK}"
DIAG_DATE = "TRY_CAST(diagnosis_date AS DATE)"
CONDITION_KEY = f"concat_ws(':', encounter_id, upper(trim(icd10_code)), {DIAG_DATE})"
CONDITION_SQL = (
    f"SELECT {sha_key(CONDITION_KEY)} AS condition_occurrence_id, "
    f"{sha_key('raw_patient_id')} AS person_id, {ICD10_SQL} AS condition_concept_id, "
    f"CAST({DIAG_DATE} AS VARCHAR) AS condition_start_date, "
    "CAST(NULL AS TIMESTAMP) AS condition_start_datetime, CAST(NULL AS VARCHAR) AS condition_end_date, "
    "CAST(NULL AS TIMESTAMP) AS condition_end_datetime, 32817 AS condition_type_concept_id, "
    "CAST(NULL AS VARCHAR) AS stop_reason, CAST(NULL AS BIGINT) AS provider_id, "
    "CAST(NULL AS BIGINT) AS visit_occurrence_id, "
    "concat_ws(':', icd10_code, diagnosis_description) AS condition_source_value, "
    f"0 AS condition_source_concept_id FROM bronze_diagnoses WHERE {DIAG_DATE} IS NOT NULL"
)
LABS_SQL = (
    f"SELECT {sha_key('lab_event_id')} AS measurement_id, {sha_key('raw_patient_id')} AS person_id, "
    f"{LOINC_SQL} AS measurement_concept_id, CAST(CAST({LAB_TIME} AS DATE) AS VARCHAR) AS measurement_date, "
    f"{LAB_TIME} AS measurement_datetime, 45754907 AS measurement_type_concept_id, "
    "TRY_CAST(numeric_value AS DOUBLE) AS value_as_number, 0 AS value_as_concept_id, "
    "unit_value AS unit_source_value, concat_ws(':', loinc_code, test_name) AS measurement_source_value, "
    f"numeric_value AS value_source_value FROM bronze_labs WHERE {LAB_TIME} IS NOT NULL"
)
VARIANT_KEY = "concat_ws(':', patient_id, sample_id, chrom, pos, ref, alt, id)"
VARIANTS_SQL = (
    f"SELECT {sha_key(VARIANT_KEY)} AS measurement_id, {sha_key('patient_id')} AS person_id, "
    "35917873 AS measurement_concept_id, CAST(NULL AS VARCHAR) AS measurement_date, "
    "CAST(NULL AS TIMESTAMP) AS measurement_datetime, 4182210 AS measurement_type_concept_id, "
    "coalesce(TRY_CAST(nullif(qual, '.') AS DOUBLE), 0.0) AS value_as_number, "
    f"{CLINVAR_SQL} AS value_as_concept_id, 'VCF_QUAL' AS unit_source_value, "
    "concat_ws(':', sample_id, filter) AS measurement_source_value, "
    f"concat_ws(':', chrom, pos, ref, alt, id, {GENE_SQL}, {CLNSIG_SQL}) AS value_source_value "
    "FROM bronze_variants WHERE filter IN ('PASS', '.')"
)


@query("omop_person", PERSON_SQL, P)
def omop_person(spark, sf_dir):
    return plain(gold(spark, sf_dir)["person"])


@query("omop_condition", CONDITION_SQL, D)
def omop_condition(spark, sf_dir):
    return plain(gold(spark, sf_dir)["condition_occurrence"])


@query("omop_measurement_labs", LABS_SQL, L)
def omop_measurement_labs(spark, sf_dir):
    accepted = silver.silver_labs(view(spark, sf_dir, "bronze_labs")).accepted
    return plain(omop.measurement_from_labs(accepted, key_style=KEYS))


@query("omop_measurement_variants", VARIANTS_SQL, V)
def omop_measurement_variants(spark, sf_dir):
    accepted = silver.silver_variants(view(spark, sf_dir, "bronze_variants")).accepted
    return plain(omop.measurement_from_variants(accepted, key_style=KEYS))


@query("omop_measurement", f"SELECT * FROM ({LABS_SQL}) UNION ALL SELECT * FROM ({VARIANTS_SQL})", L + V)
def omop_measurement(spark, sf_dir):
    return plain(gold(spark, sf_dir)["measurement"])


@query(
    "omop_gold_counts",
    "SELECT 'person' AS table_name, count(*) AS rows, count(DISTINCT person_source_value) AS persons, "
    f"count_if(gender_concept_id <> 0) AS mapped_rows FROM ({PERSON_SQL}) "
    "UNION ALL SELECT 'condition_occurrence', count(*), count(DISTINCT person_id), "
    f"count_if(condition_concept_id <> 0) FROM ({CONDITION_SQL}) "
    "UNION ALL SELECT 'measurement', count(*), count(DISTINCT person_id), "
    "count_if(measurement_concept_id <> 0) FROM "
    f"(SELECT * FROM ({LABS_SQL}) UNION ALL SELECT * FROM ({VARIANTS_SQL}))",
    P + D + L + V,
    longs=("mapped_rows",),
)
def omop_gold_counts(spark, sf_dir):
    """All sources through parsing, accept filters and transforms, with the default keys."""
    return count_gold(gold(spark, sf_dir, key_style="masked"))


@query(
    "omop_upsert_counts",
    "SELECT 'person' AS table_name, count(DISTINCT person_id) AS rows, count(DISTINCT person_id) AS persons, "
    f"count(DISTINCT person_id) FILTER (gender_concept_id <> 0) AS mapped_rows FROM ({PERSON_SQL}) "
    "UNION ALL SELECT 'condition_occurrence', count(DISTINCT condition_occurrence_id), count(DISTINCT person_id), "
    f"count(DISTINCT condition_occurrence_id) FILTER (condition_concept_id <> 0) FROM ({CONDITION_SQL}) "
    "UNION ALL SELECT 'measurement', count(DISTINCT measurement_id), count(DISTINCT person_id), "
    "count(DISTINCT measurement_id) FILTER (measurement_concept_id <> 0) FROM "
    f"(SELECT * FROM ({LABS_SQL}) UNION ALL SELECT * FROM ({VARIANTS_SQL}))",
    P + D + L + V,
)
def omop_upsert_counts(spark, sf_dir):
    """The saved job: half of the patients first, then all sources upserted over them."""
    sources, lake = bronze(spark, sf_dir), scratch_path(spark, "omop-lake")
    half = {
        n: df.where(F.pmod(F.xxhash64("patient_id" if n == "variants" else "raw_patient_id"), F.lit(2)) == 0)
        for n, df in sources.items()
    }
    build_omop(spark, half, lake, load_mode="upsert")
    return count_gold(build_omop(spark, sources, lake, load_mode="upsert").gold)


@query(
    "union_by_name",
    "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier",
)
def union_by_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_nationkey AS nation", "s_name AS name", "s_suppkey AS id"
    )
    return columns.union_by_name(customers, suppliers)


@query(
    "row_cap",
    "SELECT lab_event_id, raw_patient_id FROM bronze_labs ORDER BY lab_event_id, raw_patient_id LIMIT 1000",
    L,
)
def row_cap(spark, sf_dir):
    labs = view(spark, sf_dir, "bronze_labs").select("lab_event_id", "raw_patient_id")
    return columns.cap_rows(labs, 1000, ["lab_event_id", "raw_patient_id"])


@query(
    "schema_registry",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {i} AS ordinal, '{c}' AS column_name, '{dt}' AS data_type, "
        f"{str(n).lower()} AS nullable, {str(pk).lower()} AS is_primary_key, "
        f"{str(ck).lower()} AS is_cluster_key, (SELECT count(*) FROM {src}) AS table_rows"
        for t, src in (
            ("person", "bronze_patients"),
            ("condition_occurrence", "bronze_diagnoses"),
            ("measurement", "bronze_labs"),
        )
        for (_, i, c, dt, n, pk, ck) in registry.registry_rows(t)
    ),
    P + D + L,
)
def schema_registry(spark, sf_dir):
    """Registered columns with the number of rows that their table would be built from."""
    sources = {"person": "patients", "condition_occurrence": "diagnoses", "measurement": "labs"}
    rows = bronze(spark, sf_dir)
    counted = columns.union_by_name(
        *[
            rows[s].agg(F.count("*").alias("table_rows")).withColumn("table_name", F.lit(t))
            for t, s in sources.items()
        ]
    )
    return registry.registry(spark, *sources).join(counted, "table_name")


def _person_conformance_sql() -> str:
    actual = {
        "person_id": "bigint", "gender_concept_id": "int", "year_of_birth": "int",
        "month_of_birth": "int", "day_of_birth": "int", "birth_datetime": "timestamp",
        "race_concept_id": "int", "ethnicity_concept_id": "int", "person_source_value": "string",
        "gender_source_value": "string", "race_source_value": "string",
        "ethnicity_source_value": "string",
    }
    lines = []
    for _, _, c, dt, nullable, pk, ck in registry.registry_rows("person"):
        if c not in actual:
            nulls, state, found = "CAST(NULL AS BIGINT)", "'MISSING'", "NULL"
        else:
            nulls, found = f"count_if({c} IS NULL)", f"'{actual[c]}'"
            state = "'OK'" if nullable else f"CASE WHEN count_if({c} IS NULL) > 0 THEN 'NULLS_IN_REQUIRED' ELSE 'OK' END"
        lines.append(
            f"SELECT 'person' AS table_name, '{c}' AS column_name, '{dt}' AS registered_type, "
            f"{found} AS actual_type, {str(nullable).lower()} AS nullable, {str(pk).lower()} AS is_primary_key, "
            f"{str(ck).lower()} AS is_cluster_key, {nulls} AS null_rows, count(*) AS table_rows, "
            f"{state} AS status FROM ({person_columns('bronze_patients')})"
        )
    return " UNION ALL ".join(lines)


@query("schema_conformance", _person_conformance_sql(), P, longs=("null_rows",))
def schema_conformance(spark, sf_dir):
    """PERSON of all patients, quarantined ones included, against its registered schema."""
    everyone = silver.parse_patients(view(spark, sf_dir, "bronze_patients"))
    return registry.conformance(omop.person(everyone, key_style=KEYS), "person")
