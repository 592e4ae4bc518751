"""File scans: the given tables are written out in a source format and read back."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from clinlake.operators import columns, qc
from clinlake.sources import blockgzip, contracts, delimited, files, listing, vcf, vocabulary
from clinlake.workspace import scratch_path
from workload.catalog import plain, query, saved, table, view
from workload.q_columns import D, L, P, V

KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_OPTIONS = {"header": True, **KEEP_BLANKS}
PATIENT_COLUMNS = ["raw_patient_id", "gender", "birth_datetime", "race", "ethnicity"]
PATIENTS_SQL = "SELECT raw_patient_id, gender, birth_datetime, race, ethnicity FROM bronze_patients"


def patients_csv(spark, sf_dir):
    return saved(spark, view(spark, sf_dir, "bronze_patients"), "patients", "csv", **CSV_OPTIONS)


@query("csv_scan", PATIENTS_SQL, P)
def csv_scan(spark, sf_dir):
    return delimited.scan_csv(spark, patients_csv(spark, sf_dir), PATIENT_COLUMNS)


@query(
    "rename_map",
    "SELECT lab_event_id, raw_patient_id, lab_datetime, loinc_code, test_name, numeric_value, unit_value "
    "FROM bronze_labs",
    L,
)
def rename_map(spark, sf_dir):
    """A CSV export with Synthea's headers becomes a canonical source."""
    export = view(spark, sf_dir, "bronze_labs").withColumnsRenamed(
        {
            "lab_event_id": "Id", "raw_patient_id": "PATIENT", "lab_datetime": "DATE",
            "loinc_code": "CODE", "test_name": "DESCRIPTION", "numeric_value": "VALUE",
            "unit_value": "UNITS",
        }
    )
    path = saved(spark, export, "synthea-labs", "csv", **CSV_OPTIONS)
    return delimited.scan_source(spark, "labs", path, export="synthea").drop("ingestion_timestamp")


@query(
    "ingest_stamp",
    "SELECT encounter_id, icd10_code, TIMESTAMP '2024-01-02 03:04:05' AS ingestion_timestamp "
    "FROM bronze_diagnoses",
    D,
)
def ingest_stamp(spark, sf_dir):
    rows = view(spark, sf_dir, "bronze_diagnoses").select("encounter_id", "icd10_code")
    return plain(delimited.stamp_ingest(rows, datetime(2024, 1, 2, 3, 4, 5)))


@query("source_fallback", PATIENTS_SQL, P)
def source_fallback(spark, sf_dir):
    """The first path does not exist, so the second one is read."""
    absent = scratch_path(spark, "absent")
    rows = delimited.scan_source(spark, "patients", absent, patients_csv(spark, sf_dir))
    return rows.drop("ingestion_timestamp")


CUSTOMER_SCHEMA = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query(
    "multi_format_load",
    " UNION ALL ".join(
        f"SELECT '{ext}' AS format, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
        for ext in ("csv", "tsv", "json", "parquet", "txt")
    ),
)
def multi_format_load(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    loaded = []
    for extension in ("csv", "tsv", "json", "parquet", "txt"):
        path = f"{scratch_path(spark, 'customer')}.{extension}"
        if extension in ("json", "parquet"):
            customers.write.format(extension).save(path)
        else:
            sep = "\t" if extension == "tsv" else ","
            customers.write.options(sep=sep, **CSV_OPTIONS).csv(path)
        rows = delimited.load_dataset(spark, path, schema=CUSTOMER_SCHEMA)
        loaded.append(rows.withColumn("format", F.lit(extension)))
    return columns.union_by_name(*loaded)


def headed(lines, *head):
    """The rows of every partition (one column of text) behind these lines; empty partitions stay empty."""

    def run(batches):
        begun = False
        for batch in batches:
            if batch.num_rows and not begun:
                begun = True
                yield pa.RecordBatch.from_arrays([pa.array(head, pa.string())], schema=batch.schema)
            yield batch

    return lines.mapInArrow(run, "value string")


#: Twenty kinds of files: the columns from another one on, in both directions, and without gender or with it.
HEADERS = [
    [c for c in (PATIENT_COLUMNS[i:] + PATIENT_COLUMNS[:i])[::way] if keeps or c != "gender"]
    for i in range(5) for way in (1, -1) for keeps in (True, False)
]
MIXED_PATIENTS_SQL = (
    "SELECT raw_patient_id, CASE WHEN n % 2 = 0 THEN gender END AS gender, birth_datetime, race, ethnicity "
    "FROM (SELECT *, CAST(substr(raw_patient_id, 5) AS BIGINT) AS n FROM bronze_patients)"
)


@query("csv_mixed_headers", MIXED_PATIENTS_SQL, P)
def csv_mixed_headers(spark, sf_dir):
    """Twenty headers in one folder, every other one without gender."""
    kind = F.substring("raw_patient_id", 5, 20).cast("bigint") % len(HEADERS)
    cells = lambda names: F.to_csv(F.struct(*names), KEEP_BLANKS)
    line = F.coalesce(*[F.when(kind == k, cells(names)) for k, names in enumerate(HEADERS)])
    rows = view(spark, sf_dir, "bronze_patients").select(kind.alias("kind"), F.lit(1).alias("place"), line.alias("value"))
    tops = spark.createDataFrame([(k, 0, ",".join(names)) for k, names in enumerate(HEADERS)], rows.schema)
    path = scratch_path(spark, "mixed-patients")
    placed = rows.unionByName(tops).repartition("kind").sortWithinPartitions("kind", "place")
    placed.select("kind", "value").write.partitionBy("kind").text(path)
    return delimited.scan_csv_by_header(spark, path)


# -- VCF ------------------------------------------------------------------------

VCF_FIELDS = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "patient_id", "sample_id")
HEADER = "#" + "\t".join(f.upper() for f in VCF_FIELDS)
REMARKS = ("##fileformat=VCFv4.2", "##reference=GRCh38")


def vcf_file(spark, sf_dir):
    """The variants as VCF text; every thirteenth line ends before its last two fields."""
    rows = view(spark, sf_dir, "bronze_variants").withColumn("filter", F.coalesce("filter", F.lit("")))
    short = F.substring("id", 3, 20).cast("bigint") % 13 == 0
    line = F.when(short, F.concat_ws("\t", *VCF_FIELDS[:-2])).otherwise(F.concat_ws("\t", *VCF_FIELDS))
    lines = rows.select(line.alias("value"))
    top = spark.createDataFrame([(text,) for text in (*REMARKS, HEADER)], "value string").coalesce(1)
    return saved(spark, top.unionByName(lines), "variants-vcf", "text")


SHORT_LINE = "CAST(substr(id, 3) AS BIGINT) % 13 = 0"
LONG_FIELDS = ", ".join(f"coalesce({f}, '')" for f in VCF_FIELDS)
SHORT_FIELDS = ", ".join(f"coalesce({f}, '')" for f in VCF_FIELDS[:-2])


@query(
    "vcf_text_scan",
    f"SELECT '{HEADER}' AS value UNION ALL SELECT CASE WHEN {SHORT_LINE} "
    f"THEN concat_ws(chr(9), {SHORT_FIELDS}) ELSE concat_ws(chr(9), {LONG_FIELDS}) END FROM bronze_variants",
    V,
)
def vcf_text_scan(spark, sf_dir):
    return vcf.scan_lines(spark, vcf_file(spark, sf_dir))


@query(
    "vcf_header",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{f}' AS column_name"
        for i, f in enumerate(VCF_FIELDS)
    ),
)
def vcf_header(spark, sf_dir):
    lines = vcf.scan_lines(spark, vcf_file(spark, sf_dir))
    return vcf.header_columns(lines)


@query(
    "vcf_parse",
    "SELECT chrom, pos, id, ref, alt, qual, coalesce(filter, '') AS filter, info, "
    f"CASE WHEN NOT {SHORT_LINE} THEN patient_id END AS patient_id, "
    f"CASE WHEN NOT {SHORT_LINE} THEN sample_id END AS sample_id FROM bronze_variants",
    V,
)
def vcf_parse(spark, sf_dir):
    return vcf.scan_vcf(spark, vcf_file(spark, sf_dir)).drop("ingestion_timestamp")


@query(
    "vcf_mixed_headers",
    "SELECT chrom, pos, id, ref, alt, qual, coalesce(filter, '') AS filter, info, patient_id, "
    "CASE WHEN CAST(substr(id, 3) AS BIGINT) % 2 = 0 THEN sample_id END AS sample_id FROM bronze_variants",
    V,
)
def vcf_mixed_headers(spark, sf_dir):
    """Two kinds of files in one folder: one has its patients first and no samples."""
    rows = view(spark, sf_dir, "bronze_variants").withColumn("filter", F.coalesce("filter", F.lit("")))
    odd = F.substring("id", 3, 20).cast("bigint") % 2
    path = scratch_path(spark, "mixed-variants")
    for kind, names in enumerate((VCF_FIELDS, ("chrom", "patient_id", *VCF_FIELDS[1:8]))):
        header = "#" + "\t".join(f.upper() for f in names)
        lines = rows.where(odd == kind).select(F.concat_ws("\t", *names).alias("value"))
        headed(lines, *REMARKS, header).write.mode("append").text(path)
    return vcf.scan_vcf(spark, path).drop("ingestion_timestamp").select(*VCF_FIELDS)


@query(
    "vcf_block_gzip",
    "SELECT chrom, pos, id, ref, alt, qual, coalesce(filter, '') AS filter, info, patient_id, sample_id, true AS in_many_tasks "
    "FROM bronze_variants",
    V,
)
def vcf_block_gzip(spark, sf_dir):
    """Variants in block-gzip files of many blocks; their byte ranges are read by different tasks."""
    rows = view(spark, sf_dir, "bronze_variants").withColumn("filter", F.coalesce("filter", F.lit("")))
    path = f"{scratch_path(spark, 'variants')}.vcf.bgz"
    lines = rows.select(F.concat_ws("\t", *VCF_FIELDS).alias("value"))
    blockgzip.write_block_gzip(lines, path, [*REMARKS, HEADER], block_bytes=4_000)
    size = listing.list_files(spark, path).agg(F.sum("length")).first()[0]
    variants = vcf.scan_vcf(spark, path, range_bytes=max(1, size // 8)).drop("ingestion_timestamp")
    tasks = variants.select(F.spark_partition_id()).distinct().count()
    return variants.withColumn("in_many_tasks", F.lit(tasks > 1))


# -- vocabularies, contracts, digests -----------------------------------------------


def vocabulary_documents(spark, sf_dir, shift: int = 0):
    """One JSON vocabulary per part, with remarks and an unusable entry to leave out."""
    parts = table(spark, sf_dir, "part")
    body = F.concat(
        F.lit('{"_metadata": {"note": "x"}, "part_to_concept": {"_remark": "y", "n/a": "none", "P'),
        F.col("p_partkey"),
        F.lit('": '),
        F.col("p_partkey") + F.when(F.col("p_partkey") % 7 == 0, shift).otherwise(0),
        F.lit('}, "brand_to_concept": {"'),
        F.col("p_brand"),
        F.lit("-"),
        F.col("p_partkey"),
        F.lit('": '),
        F.col("p_size"),
        F.lit("}}"),
    )
    return parts.select(body.alias("value"))


VOCABULARY_SQL = (
    "SELECT 'part_to_concept' AS category, concat('P', p_partkey) AS source_code, "
    "CAST(p_partkey AS INTEGER) AS concept_id FROM part UNION ALL "
    "SELECT 'brand_to_concept', concat(p_brand, '-', p_partkey), p_size FROM part"
)


@query("vocab_table", VOCABULARY_SQL)
def vocab_table(spark, sf_dir):
    return vocabulary.entries_of(vocabulary_documents(spark, sf_dir))


@query(
    "vocab_one_document",
    f"SELECT *, true AS in_many_tasks FROM ({VOCABULARY_SQL})",
)
def vocab_one_document(spark, sf_dir):
    """All parts in one JSON file, whose byte ranges are read by different tasks."""
    parts = table(spark, sf_dir, "part")
    pair = lambda code, concept: F.concat(F.lit('"'), code, F.lit('": '), concept)
    kinds = {
        "part_to_concept": pair(F.concat(F.lit("P"), "p_partkey"), F.col("p_partkey")),
        "brand_to_concept": pair(F.concat_ws("-", "p_brand", "p_partkey"), F.col("p_size")),
    }
    lines = None
    for n, (name, entry) in enumerate(kinds.items()):
        opening = ("}, " if n else '{"_metadata": {"note": "{[\\"\\\\", "deep": [{"x": 1}]}, ') + f'"{name}": {{"_remark": "y"'
        own = parts.select(F.lit(2 * n + 1).alias("place"), F.concat(F.lit(", "), entry).alias("value"))
        head = spark.range(1).select(F.lit(2 * n).alias("place"), F.lit(opening).alias("value"))
        lines = head.unionByName(own) if lines is None else lines.unionByName(head).unionByName(own)
    lines = lines.unionByName(spark.range(1).select(F.lit(9).alias("place"), F.lit("}}").alias("value")))
    path = scratch_path(spark, "vocabulary")
    lines.coalesce(1).sortWithinPartitions("place").select("value").write.text(path)
    size = listing.list_files(spark, path).agg(F.sum("length")).first()[0]
    entries = vocabulary.scanned_entries(spark, path, max(64, size // 12))
    return entries.withColumn("in_many_tasks", F.lit(size > 12 * 64))


@query("vocab_category", f"SELECT * FROM ({VOCABULARY_SQL}) WHERE category = 'brand_to_concept'")
def vocab_category(spark, sf_dir):
    entries = vocabulary.entries_of(vocabulary_documents(spark, sf_dir))
    return vocabulary.category(entries, " Brand_To_Concept ")


@query(
    "vocab_drift",
    "SELECT 'part_to_concept' AS category, concat('P', p_partkey) AS source_code, "
    "CAST(p_partkey AS INTEGER) AS old_concept_id, CAST(p_partkey + 5 AS INTEGER) AS new_concept_id, "
    "'changed' AS change FROM part WHERE p_partkey % 7 = 0",
)
def vocab_drift(spark, sf_dir):
    old = vocabulary.entries_of(vocabulary_documents(spark, sf_dir))
    new = vocabulary.entries_of(vocabulary_documents(spark, sf_dir, shift=5))
    return vocabulary.drift(old, new)


CONTRACT_DOCUMENT = (
    """concat('{"data_asset_type": "part", "expectation_suite_name": "suite_', p_partkey, '", """
    """"meta": {"owner": "', p_brand, '"}, "expectations": [{"expectation_type": """
    """"expect_column_values_to_not_be_null", "kwargs": {"column": "p_name"}, """
    """"meta": {"severity": "WARNING"}}, {"expectation_type": "expect_column_values_to_be_in_set", """
    """"kwargs": {"column": "p_size", "value_set": [', p_size, ',0]}}]}')"""
)


@query(
    "contract_rules",
    f"SELECT concat('suite_', p_partkey) AS suite_name, sha256({CONTRACT_DOCUMENT}) AS rules_sha256, "
    "p_brand AS owner, 2 AS expectations_count, r.position, r.expectation_type, r.column_name, r.severity, "
    "CASE WHEN r.position = 1 THEN concat('[', p_size, ',0]') END AS value_set FROM part, "
    "(VALUES (0, 'expect_column_values_to_not_be_null', 'p_name', 'WARNING'), "
    "(1, 'expect_column_values_to_be_in_set', 'p_size', 'ERROR')) "
    "AS r(position, expectation_type, column_name, severity)",
)
def contract_rules(spark, sf_dir):
    documents = table(spark, sf_dir, "part").selectExpr(f"{CONTRACT_DOCUMENT} AS value")
    rules = contracts.rules_of(documents)
    return rules.select(
        "suite_name", "rules_sha256", F.col("meta")["owner"].alias("owner"), "expectations_count",
        "position", "expectation_type", "column_name", "severity",
        F.col("options")["value_set"].alias("value_set"),
    )


@query(
    "sha256_manifest",
    "SELECT doc_id, sha256(text) AS text_sha256, "
    "sha256(concat_ws(chr(31), doc_id, coalesce(lang, chr(0)), coalesce(source, chr(0)))) AS row_sha256 "
    "FROM documents",
)
def sha256_manifest(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        files.text_digest("text").alias("text_sha256"),
        files.row_digest(["doc_id", "lang", "source"]).alias("row_sha256"),
    )


@query(
    "file_sha256_manifest",
    "SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS length, "
    "sha256(coalesce(text, '') || chr(10)) AS sha256 FROM documents",
)
def file_sha256_manifest(spark, sf_dir):
    """Every document as a text file of its own, and the digests of all these files."""
    path = scratch_path(spark, "document-files")
    folders = files.write_each(table(spark, sf_dir, "documents"), path, "doc_id", "text")
    manifest = files.file_manifest(spark, folders, "*.txt")
    return manifest.select(
        F.regexp_extract("path", r"/(-?\d+|null)-\d+\.txt$", 1).try_cast("bigint").alias("doc_id"), "length", "sha256"
    )


@query(
    "qc_status_rollup",
    "SELECT report, status, count(*) AS lines FROM (SELECT concat('sample_', l_suppkey) AS report, "
    "CASE l_linenumber % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARN' WHEN 2 THEN 'FAIL' END AS status "
    "FROM lineitem) WHERE status IS NOT NULL GROUP BY report, status",
)
def qc_status_rollup(spark, sf_dir):
    """Report lines as FastQC writes them; a quarter of them has no status."""
    word = F.when(F.col("l_linenumber") % 4 == 0, "PASS").when(
        F.col("l_linenumber") % 4 == 1, "WARN"
    ).when(F.col("l_linenumber") % 4 == 2, "FAIL").otherwise(">>END_MODULE")
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("sample_"), "l_suppkey").alias("report"),
        F.concat_ws("\t", word, F.lit("Per base quality"), "l_orderkey").alias("value"),
    )
    return qc.status_rollup(lines)
