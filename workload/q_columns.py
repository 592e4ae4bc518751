"""Scalar functions, silver split and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinlake.functions import keys, lookup, parsing
from clinlake.fixed_values import CONCEPTS
from clinlake.operators import columns, concept_tools, silver
from workload.catalog import plain, query, table, view

P, D, L, V, R = (
    ("bronze_patients",), ("bronze_diagnoses",), ("bronze_labs",), ("bronze_variants",),
    ("run_ledger",),
)
BIRTH = (
    "coalesce(TRY_CAST(birth_datetime AS TIMESTAMP), "
    "CAST(TRY_CAST(birth_datetime AS DATE) AS TIMESTAMP))"
)
LAB_TIME = (
    "coalesce(TRY_CAST(lab_datetime AS TIMESTAMP), "
    "CAST(TRY_CAST(lab_datetime AS DATE) AS TIMESTAMP))"
)
GENDER_OK = "coalesce(upper(trim(gender)) IN ('MALE', 'FEMALE', 'M', 'F', 'UNKNOWN'), false)"
PATIENT_OK = f"({BIRTH} IS NOT NULL AND {GENDER_OK})"


def sha_key(text: str) -> str:
    return f"CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT)"


def sql_case(code: str, mapping: dict[str, int], default: int = 0) -> str:
    """A mapping written out as SQL, for the oracle side."""
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {code} {whens} ELSE {default} END"


ICD10_SQL = sql_case(
    "replace(upper(trim(icd10_code)), '.', '')",
    {k: v for k, v in CONCEPTS["icd10_to_snomed"].items() if "." not in k},
)
LOINC_SQL = sql_case("upper(trim(loinc_code))", CONCEPTS["loinc_to_concept"])
GENDER_SQL = sql_case("upper(trim(gender))", CONCEPTS["gender_to_concept"])
RACE_SQL = sql_case("upper(trim(race))", CONCEPTS["race_to_concept"])
ETHNICITY_SQL = sql_case("upper(trim(ethnicity))", CONCEPTS["ethnicity_to_concept"])
CLNSIG_SQL = "regexp_extract(info, '(?:^|;)CLNSIG=([^;]+)', 1)"
GENE_SQL = "regexp_extract(info, '(?:^|;)GENE=([^;]+)', 1)"
CLINVAR_SQL = sql_case(CLNSIG_SQL, CONCEPTS["clinvar_to_concept"])


@query("safe_timestamp", f"SELECT raw_patient_id, birth_datetime, {BIRTH} AS parsed FROM bronze_patients", P)
def safe_timestamp(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_patients")
    return plain(
        df.select(
            "raw_patient_id", "birth_datetime", parsing.safe_timestamp("birth_datetime").alias("parsed")
        )
    )


@query(
    "safe_date",
    "SELECT encounter_id, CAST(TRY_CAST(diagnosis_date AS DATE) AS VARCHAR) AS parsed FROM bronze_diagnoses",
    D,
)
def safe_date(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_diagnoses")
    return plain(df.select("encounter_id", parsing.safe_date("diagnosis_date").alias("parsed")))


@query(
    "safe_number",
    "SELECT lab_event_id, TRY_CAST(numeric_value AS DOUBLE) AS value_as_number, "
    "numeric_value AS value_source_value FROM bronze_labs",
    L,
)
def safe_number(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_labs")
    return df.select(
        "lab_event_id",
        parsing.safe_number("numeric_value").alias("value_as_number"),
        F.col("numeric_value").alias("value_source_value"),
    )


@query(
    "sentinel_number",
    "SELECT id, coalesce(TRY_CAST(nullif(qual, '.') AS DOUBLE), 0.0) AS quality FROM bronze_variants",
    V,
)
def sentinel_number(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_variants")
    return df.select("id", parsing.number_or_zero("qual").alias("quality"))


@query(
    "normalise_code",
    "SELECT encounter_id, upper(trim(icd10_code)) AS code, "
    "replace(upper(trim(icd10_code)), '.', '') AS dotless FROM bronze_diagnoses",
    D,
)
def normalise_code(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_diagnoses")
    return df.select(
        "encounter_id",
        parsing.normalise("icd10_code").alias("code"),
        parsing.normalise_dotless("icd10_code").alias("dotless"),
    )


@query(
    "silver_accept",
    f"SELECT 'patients' AS source, raw_patient_id AS row_key FROM bronze_patients WHERE {PATIENT_OK} "
    "UNION ALL SELECT 'diagnoses', encounter_id FROM bronze_diagnoses "
    "WHERE TRY_CAST(diagnosis_date AS DATE) IS NOT NULL "
    f"UNION ALL SELECT 'labs', lab_event_id FROM bronze_labs WHERE CAST({LAB_TIME} AS DATE) IS NOT NULL",
    P + D + L,
)
def silver_accept(spark, sf_dir):
    parts = [
        ("patients", silver.silver_patients, "bronze_patients", "raw_patient_id"),
        ("diagnoses", silver.silver_diagnoses, "bronze_diagnoses", "encounter_id"),
        ("labs", silver.silver_labs, "bronze_labs", "lab_event_id"),
    ]
    return columns.union_by_name(
        *[
            split(view(spark, sf_dir, name)).accepted.select(
                F.lit(source).alias("source"), F.col(key).alias("row_key")
            )
            for source, split, name, key in parts
        ]
    )


@query(
    "quarantine_split",
    f"SELECT raw_patient_id, gender, birth_datetime, {PATIENT_OK} AS accepted FROM bronze_patients",
    P,
)
def quarantine_split(spark, sf_dir):
    sides = silver.silver_patients(view(spark, sf_dir, "bronze_patients"))
    kept = ["raw_patient_id", "gender", "birth_datetime"]
    return sides.accepted.select(*kept, F.lit(True).alias("accepted")).unionByName(
        sides.rejected.select(*kept, F.lit(False).alias("accepted"))
    )


@query(
    "tier_counts",
    f"SELECT 'patients' AS source, count_if({PATIENT_OK}) AS accepted, "
    f"count_if(NOT {PATIENT_OK}) AS quarantined FROM bronze_patients "
    "UNION ALL SELECT 'diagnoses', count_if(TRY_CAST(diagnosis_date AS DATE) IS NOT NULL), "
    "count_if(TRY_CAST(diagnosis_date AS DATE) IS NULL) FROM bronze_diagnoses "
    f"UNION ALL SELECT 'labs', count_if({LAB_TIME} IS NOT NULL), count_if({LAB_TIME} IS NULL) FROM bronze_labs "
    "UNION ALL SELECT 'variants', count_if(coalesce(filter IN ('PASS', '.'), false)), "
    "count_if(NOT coalesce(filter IN ('PASS', '.'), false)) FROM bronze_variants",
    P + D + L + V,
    longs=("accepted", "quarantined"),
)
def tier_counts(spark, sf_dir):
    return silver.tier_counts(
        {
            "patients": (
                silver.parse_patients(view(spark, sf_dir, "bronze_patients")), silver.patient_is_valid()
            ),
            "diagnoses": (
                silver.parse_diagnoses(view(spark, sf_dir, "bronze_diagnoses")),
                silver.diagnosis_is_valid(),
            ),
            "labs": (silver.parse_labs(view(spark, sf_dir, "bronze_labs")), silver.lab_is_valid()),
            "variants": (view(spark, sf_dir, "bronze_variants"), silver.variant_is_valid()),
        }
    )


@query(
    "variant_pass_filter",
    "SELECT id, chrom, pos, filter FROM bronze_variants WHERE filter IN ('PASS', '.')",
    V,
)
def variant_pass_filter(spark, sf_dir):
    accepted = silver.silver_variants(view(spark, sf_dir, "bronze_variants")).accepted
    return accepted.select("id", "chrom", "pos", "filter")


@query(
    "surrogate_key",
    f"SELECT raw_patient_id, {sha_key('raw_patient_id')} AS digest_key, true AS masked_ok, "
    "true AS absolute_ok FROM bronze_labs",
    L,
)
def surrogate_key(spark, sf_dir):
    """The digest key exactly; of the hashed keys that they are there and not negative."""
    df = view(spark, sf_dir, "bronze_labs")
    return df.select(
        "raw_patient_id",
        keys.surrogate_key("raw_patient_id", style="digest").alias("digest_key"),
        (keys.surrogate_key("raw_patient_id") >= 0).alias("masked_ok"),
        (keys.surrogate_key("raw_patient_id", style="absolute") >= 0).alias("absolute_ok"),
    )


@query(
    "key_uniqueness",
    "SELECT count(*) AS rows, count(DISTINCT lab_event_id) AS sources, "
    "count(DISTINCT lab_event_id) AS masked_keys, count(DISTINCT lab_event_id) AS absolute_keys "
    "FROM bronze_labs",
    L,
)
def key_uniqueness(spark, sf_dir):
    """Different sources get different hashed keys."""
    per_source = (
        view(spark, sf_dir, "bronze_labs").groupBy("lab_event_id").agg(F.count("*").alias("n"))
    )
    keyed = per_source.select(
        "n",
        keys.surrogate_key("lab_event_id").alias("masked"),
        keys.surrogate_key("lab_event_id", style="absolute").alias("absolute"),
    )
    sums = keyed.agg(F.sum("n").alias("rows"), F.count("*").alias("sources"))
    masked = keyed.select("masked").distinct().agg(F.count("*").alias("masked_keys"))
    absolute = keyed.select("absolute").distinct().agg(F.count("*").alias("absolute_keys"))
    merged = columns.union_by_name(sums, masked, absolute)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


COMPOSITE = (
    "concat_ws(':', coalesce(patient_id, chr(0)), coalesce(sample_id, chr(0)), "
    "coalesce(filter, chr(0)), coalesce(pos, chr(0)))"
)


@query("composite_key", f"SELECT id, {sha_key(COMPOSITE)} AS composite_key FROM bronze_variants", V)
def composite_key(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_variants")
    key = keys.surrogate_key("patient_id", "sample_id", "filter", "pos", style="digest")
    return df.select("id", key.alias("composite_key"))


@query(
    "date_parts",
    f"SELECT raw_patient_id, year({BIRTH}) AS y, month({BIRTH}) AS m, day({BIRTH}) AS d FROM bronze_patients",
    P,
)
def date_parts(spark, sf_dir):
    parsed = silver.parse_patients(view(spark, sf_dir, "bronze_patients"))
    year, month, day = parsing.date_parts("parsed_birth_dt")
    return parsed.select("raw_patient_id", year.alias("y"), month.alias("m"), day.alias("d"))


@query("info_extract", f"SELECT id, {GENE_SQL} AS gene, {CLNSIG_SQL} AS clnsig FROM bronze_variants", V)
def info_extract(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_variants")
    return df.select(
        "id",
        parsing.info_value("info", "GENE").alias("gene"),
        parsing.info_value("info", "CLNSIG").alias("clnsig"),
    )


@query(
    "source_value",
    "SELECT id, concat_ws(':', sample_id, filter) AS source_value FROM bronze_variants",
    V,
)
def source_value(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_variants")
    return df.select("id", parsing.joined_source_value("sample_id", "filter").alias("source_value"))


@query(
    "adaptive_columns",
    "SELECT id, patient_id AS patient, CAST(NULL AS VARCHAR) AS batch, 'none' AS site FROM bronze_variants",
    V,
)
def adaptive_columns(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_variants").withColumnRenamed("patient_id", "PATIENT")
    return df.select(
        "id",
        columns.first_present(df, "patient_id", "patient").alias("patient"),
        columns.first_present(df, "batch_id", "batch").alias("batch"),
        columns.first_present(df, "site", absent="none").alias("site"),
    )


@query(
    "iso_format",
    f"SELECT raw_patient_id, strftime({BIRTH}, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM bronze_patients",
    P,
)
def iso_format(spark, sf_dir):
    parsed = silver.parse_patients(view(spark, sf_dir, "bronze_patients"))
    iso = parsing.iso_text("parsed_birth_dt", parsed.schema["parsed_birth_dt"].dataType)
    return parsed.select("raw_patient_id", iso.alias("iso"))


@query(
    "valid_sha256",
    "SELECT run_id, coalesce(regexp_full_match(trim(data_sha256), '[a-fA-F0-9]{64}'), false) AS data_ok, "
    "coalesce(regexp_full_match(trim(rules_sha256), '[a-fA-F0-9]{64}'), false) AS rules_ok FROM run_ledger",
    R,
)
def valid_sha256(spark, sf_dir):
    df = view(spark, sf_dir, "run_ledger")
    return df.select(
        "run_id",
        parsing.is_sha256("data_sha256").alias("data_ok"),
        parsing.is_sha256("rules_sha256").alias("rules_ok"),
    )


# -- look-ups -------------------------------------------------------------------


@query("concept_lookup_map", f"SELECT lab_event_id, {LOINC_SQL} AS concept_id FROM bronze_labs", L)
def concept_lookup_map(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_labs")
    concept = lookup.normalised_concept_of("loinc_code", CONCEPTS["loinc_to_concept"])
    return df.select("lab_event_id", concept.alias("concept_id"))


def part_vocabulary(spark, sf_dir):
    """A vocabulary that grows with the data: brand and type of a part make its code."""
    return table(spark, sf_dir, "part").select(
        F.lit("part_to_concept").alias("category"),
        F.concat_ws("-", "p_brand", F.col("p_partkey") % 4000).alias("source_code"),
        (F.lit(1000) + F.col("p_partkey")).cast("int").alias("concept_id"),
    )


PART_CODES = (
    "SELECT concat_ws('-', p_brand, p_partkey % 4000) AS code, min(1000 + p_partkey) AS concept "
    "FROM part GROUP BY 1"
)


def part_codes_in_lineitem(spark, sf_dir):
    """Codes to look up; a third of all rows carries the same one."""
    line = table(spark, sf_dir, "lineitem")
    code = F.when(F.col("l_linenumber") % 3 == 0, F.lit("Brand#1-1")).otherwise(
        F.concat(F.lit("Brand#"), 1 + F.col("l_suppkey") % 25, F.lit("-"), F.col("l_partkey") % 4000)
    )
    return line.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", code.alias("code"))


LOOKUP_JOIN_SQL = (
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, c.code, "
    "CAST(coalesce(v.concept, 0) AS INTEGER) AS concept_id FROM ("
    "SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN 'Brand#1-1' "
    "ELSE concat('Brand#', 1 + l_suppkey % 25, '-', l_partkey % 4000) END AS code FROM lineitem) c "
    f"LEFT JOIN ({PART_CODES}) v ON c.code = v.code"
)


@query("concept_lookup_join", LOOKUP_JOIN_SQL)
def concept_lookup_join(spark, sf_dir):
    """Vocabulary table against a fact table: broadcast, because its size is checked."""
    return lookup.join_concepts(
        part_codes_in_lineitem(spark, sf_dir), "code", part_vocabulary(spark, sf_dir), "concept_id"
    )


@query("concept_lookup_salted", LOOKUP_JOIN_SQL)
def concept_lookup_salted(spark, sf_dir):
    """The same look-up in the form for vocabularies too large to broadcast."""
    return lookup.join_concepts(
        part_codes_in_lineitem(spark, sf_dir), "code", part_vocabulary(spark, sf_dir), "concept_id",
        broadcast_bytes=0, hot_rows=5_000,
    )


COLLIDING_SQL = "SELECT c_custkey, CAST(c_nationkey + 50 AS INTEGER) AS concept_id FROM customer"


def colliding_codes(spark, sf_dir):
    """Customers with their nation's name, and codes of which two meet once they are normalised."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    codes = nation.select(
        F.lit("nation_to_concept").alias("category"),
        F.explode(F.array(
            F.struct(F.concat("n_name", F.lit(".1")).alias("code"), (F.col("n_nationkey") + 900).alias("id")),
            F.struct(F.lower(F.concat("n_name", F.lit("1"))).alias("code"), (F.col("n_nationkey") + 50).alias("id")),
        )).alias("c"),
    ).select("category", F.col("c.code").alias("source_code"), F.col("c.id").cast("int").alias("concept_id"))
    customers = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return customers.select("c_custkey", F.concat("n_name", F.lit(".1")).alias("code")), codes


@query("concept_collisions_map", COLLIDING_SQL)
def concept_collisions_map(spark, sf_dir):
    """The dictionary of a small table (nation has 25 rows): a map literal."""
    df, codes = colliding_codes(spark, sf_dir)
    entries = {r["source_code"]: r["concept_id"] for r in codes.collect()}
    return lookup.with_concept(df, "concept_id", "code", entries, "dotless").drop("code")


@query("concept_collisions_dictionary", COLLIDING_SQL)
def concept_collisions_dictionary(spark, sf_dir):
    """The same dictionary grown beyond a map literal by codes that nobody has: a join."""
    df, codes = colliding_codes(spark, sf_dir)
    entries = {r["source_code"]: r["concept_id"] for r in codes.collect()}
    entries |= {f"unused-{i}": i for i in range(lookup.MAP_LITERAL_ENTRIES + 1)}
    return lookup.with_concept(df, "concept_id", "code", entries, "dotless").drop("code")


@query("concept_collisions_broadcast", COLLIDING_SQL)
def concept_collisions_broadcast(spark, sf_dir):
    df, codes = colliding_codes(spark, sf_dir)
    return lookup.with_concept(df, "concept_id", "code", codes, "dotless").drop("code")


@query("concept_collisions_split", COLLIDING_SQL)
def concept_collisions_split(spark, sf_dir):
    """The form for vocabularies too large to broadcast, with every code dealt over several parts."""
    df, codes = colliding_codes(spark, sf_dir)
    shape = lookup.CODE_FORMS["dotless"][0]
    codes = codes.withColumn("source_code", shape("source_code"))
    return lookup.join_concepts(
        df, shape("code"), codes, "concept_id", broadcast_bytes=0, hot_rows=10
    ).drop("code")


@query("icd10_lookup", f"SELECT encounter_id, {ICD10_SQL} AS concept_id FROM bronze_diagnoses", D)
def icd10_lookup(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_diagnoses")
    concept = lookup.icd10_concept_of("icd10_code", CONCEPTS["icd10_to_snomed"])
    return df.select("encounter_id", concept.alias("concept_id"))


@query(
    "lookup_icd10",
    "SELECT encounter_id, icd10_code, upper(trim(icd10_code)) AS normalized_code, "
    f"{ICD10_SQL} AS standard_concept_id, 'SNOMED' AS vocabulary_id, 'Condition' AS domain_id, "
    "'CONDITION_OCCURRENCE' AS target_table, 'condition_concept_id' AS target_field, "
    f"({ICD10_SQL}) <> 0 AS found, CASE WHEN ({ICD10_SQL}) <> 0 "
    f"THEN concat('Condition concept ', {ICD10_SQL}) ELSE concat('no concept for ', icd10_code) END "
    "AS description FROM bronze_diagnoses",
    D,
)
def lookup_icd10(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_diagnoses").select("encounter_id", "icd10_code")
    return concept_tools.lookup_icd10(df, "icd10_code")


@query(
    "lookup_loinc",
    "SELECT lab_event_id, loinc_code, upper(trim(loinc_code)) AS normalized_code, "
    f"{LOINC_SQL} AS standard_concept_id, 'LOINC' AS vocabulary_id, 'Measurement' AS domain_id, "
    "'MEASUREMENT' AS target_table, 'measurement_concept_id' AS target_field, "
    f"({LOINC_SQL}) <> 0 AS found, CASE WHEN ({LOINC_SQL}) <> 0 "
    f"THEN concat('Measurement concept ', {LOINC_SQL}) ELSE concat('no concept for ', loinc_code) END "
    "AS description FROM bronze_labs",
    L,
)
def lookup_loinc(spark, sf_dir):
    df = view(spark, sf_dir, "bronze_labs").select("lab_event_id", "loinc_code")
    return concept_tools.lookup_loinc(df, "loinc_code")


_DEMOGRAPHICS = (
    "SELECT raw_patient_id, 'Gender' AS domain, gender AS value FROM bronze_patients "
    "UNION ALL SELECT raw_patient_id, ' race', race FROM bronze_patients "
    "UNION ALL SELECT raw_patient_id, 'ethnicity', ethnicity FROM bronze_patients "
    "UNION ALL SELECT raw_patient_id, 'zodiac', race FROM bronze_patients"
)
_DEMOGRAPHIC_CONCEPT = "CASE lower(trim(domain)) " + " ".join(
    f"WHEN '{d}' THEN {sql_case('upper(trim(value))', CONCEPTS[d + '_to_concept'])}"
    for d in ("gender", "race", "ethnicity")
) + " ELSE 0 END"


@query(
    "lookup_demographic",
    "SELECT raw_patient_id, domain, value, lower(trim(domain)) AS normalized_domain, "
    f"upper(trim(value)) AS normalized_value, {_DEMOGRAPHIC_CONCEPT} AS standard_concept_id, "
    "CASE WHEN domain <> 'zodiac' THEN 'PERSON' END AS target_table, "
    "CASE WHEN domain <> 'zodiac' THEN concat(lower(trim(domain)), '_concept_id') END AS target_field, "
    f"({_DEMOGRAPHIC_CONCEPT}) <> 0 AS found, "
    "CASE WHEN domain = 'zodiac' THEN 'unknown demographic domain: zodiac' END AS error "
    f"FROM ({_DEMOGRAPHICS})",
    P,
)
def lookup_demographic(spark, sf_dir):
    patients = view(spark, sf_dir, "bronze_patients")
    pairs = F.array(
        *[
            F.struct(F.lit(domain).alias("domain"), F.col(value).alias("value"))
            for domain, value in (
                ("Gender", "gender"), (" race", "race"), ("ethnicity", "ethnicity"), ("zodiac", "race"),
            )
        ]
    )
    asked = patients.select("raw_patient_id", F.inline(pairs))
    return concept_tools.lookup_demographic(asked, "domain", "value")


_CLINVAR_ANY = sql_case("lower(clnsig)", {k.lower(): v for k, v in CONCEPTS["clinvar_to_concept"].items()})


@query(
    "lookup_clinvar",
    f"SELECT id, clnsig, {_CLINVAR_ANY} AS standard_concept_id, 'Meas Value' AS domain_id, "
    "'MEASUREMENT' AS target_table, 'value_as_concept_id' AS target_field, "
    f"({_CLINVAR_ANY}) <> 0 AS found, CASE WHEN ({_CLINVAR_ANY}) <> 0 "
    f"THEN concat('Meas Value concept ', {_CLINVAR_ANY}) ELSE concat('no concept for ', clnsig) END "
    f"AS description FROM (SELECT id, CASE WHEN length(id) % 2 = 0 THEN upper({CLNSIG_SQL}) "
    f"ELSE {CLNSIG_SQL} END AS clnsig FROM bronze_variants)",
    V,
)
def lookup_clinvar(spark, sf_dir):
    significance = parsing.info_value("info", "CLNSIG")
    odd_case = F.when(F.length("id") % 2 == 0, F.upper(significance)).otherwise(significance)
    asked = view(spark, sf_dir, "bronze_variants").select("id", odd_case.alias("clnsig"))
    return concept_tools.lookup_clinvar(asked, "clnsig")
