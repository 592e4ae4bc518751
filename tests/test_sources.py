"""Scans of files, vocabularies, contracts and digests."""

from __future__ import annotations

import gzip
import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import workload
from clinlake.fixed_values import CONCEPTS
from clinlake.operators import qc, silver
from clinlake.plans.governance_job import data_digest
from clinlake.sources import contracts, delimited, files, vcf, vocabulary
from tests.conftest import TESTDATA, rows


def test_csv_columns_stay_strings(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("id,n\nA,1\nB,\n")
    df = delimited.scan_csv(spark, str(path), ["id", "n"])
    assert df.dtypes == [("id", "string"), ("n", "string")] and rows(df) == [("A", "1"), ("B", None)]
    assert delimited.scan_csv(spark, str(path)).dtypes == df.dtypes
    with pytest.raises(Exception, match="(?i)header"):
        delimited.scan_csv(spark, str(path), ["id", "other"]).collect()


def test_synthea_export_is_renamed(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Id,BIRTHDATE,GENDER,RACE,ETHNICITY,CITY\n1,1990-01-01,M,white,hispanic,Bo\n")
    df = delimited.scan_source(spark, "patients", str(tmp_path / "p.csv"), export="synthea", as_of=datetime(2024, 1, 1))
    assert df.columns == ["raw_patient_id", "birth_datetime", "gender", "race", "ethnicity", "CITY", "ingestion_timestamp"]
    assert df.first()["ingestion_timestamp"] == datetime(2024, 1, 1)


def test_first_existing_path_wins(spark, tmp_path):
    good = tmp_path / "b.csv"
    good.write_text("x\n")
    assert delimited.first_existing(spark, str(tmp_path / "a.csv"), str(good)) == str(good)
    with pytest.raises(FileNotFoundError):
        delimited.first_existing(spark, str(tmp_path / "a.csv"))


def test_missing_columns_of_a_source_are_reported(spark, tmp_path):
    (tmp_path / "p.csv").write_text("raw_patient_id,gender\nA,M\n")
    with pytest.raises(ValueError, match="birth_datetime"):
        delimited.scan_source(spark, "patients", str(tmp_path / "p.csv"))


def test_datasets_by_extension(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\nA,1\n")
    (tmp_path / "a.tsv").write_text("id\tn\nA\t1\n")
    (tmp_path / "a.json").write_text('{"id": "A", "n": 1}\n')
    (tmp_path / "a.dat").write_text("id,n\nA,1\n")
    spark.createDataFrame([("A", 1)], "id string, n int").write.parquet(str(tmp_path / "a.parquet"))
    for extension in ("csv", "tsv", "json", "dat", "parquet"):
        df = delimited.load_dataset(spark, str(tmp_path / f"a.{extension}"))
        assert rows(df.select("id", F.col("n").cast("int"))) == [("A", 1)], extension
    (tmp_path / "b.json").write_text('[{"id": "A", "n": 1}, {"id": "B", "n": 2}]')
    assert delimited.load_dataset(spark, str(tmp_path / "b.json"), json_array=True).count() == 2
    untyped = delimited.load_dataset(spark, str(tmp_path / "a.csv"), infer_types=False)
    assert untyped.dtypes == [("id", "string"), ("n", "string")]
    with pytest.raises(FileNotFoundError):
        delimited.load_dataset(spark, str(tmp_path / "sample.csv"))


VCF = (
    "##fileformat=VCFv4.2\n##source=x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
    "chr1\t10\trs1\tA\tT\t99\tPASS\tGENE=G\nchr2\t20\trs2\tC\tG\n"
)


def test_vcf_short_lines_end_in_nulls(spark, tmp_path):
    path = tmp_path / "v.vcf"
    path.write_text(VCF)
    df = vcf.scan_vcf(spark, str(path))
    assert df.columns == ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "ingestion_timestamp"]
    assert rows(df.select("id", "qual", "filter")) == [("rs1", "99", "PASS"), ("rs2", None, None)]
    assert silver.silver_variants(df).rejected.count() == 1
    assert vcf.scan_vcf(spark, str(path), max_rows=1).count() == 1


def test_vcf_may_be_compressed(spark, tmp_path):
    path = tmp_path / "v.vcf.gz"
    path.write_bytes(gzip.compress(VCF.encode()))
    df = vcf.scan_vcf(spark, str(tmp_path / "absent.vcf"), str(path))
    assert df.count() == 2 and "rebalance" in df._jdf.queryExecution().toString().lower()


def test_vcf_without_header_is_refused(spark, tmp_path):
    path = tmp_path / "v.vcf"
    path.write_text("##x\nchr1\t10\n")
    with pytest.raises(ValueError):
        vcf.scan_vcf(spark, str(path))


def test_vocabulary_file_overrides_categories_it_has(spark, tmp_path):
    path = tmp_path / "v.json"
    path.write_text(
        json.dumps({"_metadata": {"x": 1}, "gender_to_concept": {"MALE": 1, "_comment_MALE": "x", "BAD": "n/a", "S": "7"}}, indent=1)
    )
    table = vocabulary.load_vocabulary(spark, str(path))
    entries = {(r["category"], r["source_code"]): r["concept_id"] for r in table.collect()}
    assert {c: v for (name, c), v in entries.items() if name == "gender_to_concept"} == {"MALE": 1, "S": 7}
    assert {c: v for (name, c), v in entries.items() if name == "race_to_concept"} == CONCEPTS["race_to_concept"]
    assert vocabulary.categories(table).count() == 6


def test_vocabulary_path_precedence(spark, tmp_path, monkeypatch):
    monkeypatch.setenv(vocabulary.PATH_VARIABLE, str(tmp_path / "env.json"))
    assert vocabulary.vocabulary_path("arg.json") == "arg.json"
    assert vocabulary.vocabulary_path() == str(tmp_path / "env.json")
    # A file that does not exist leaves the built-in vocabulary.
    assert vocabulary.load_vocabulary(spark).count() == sum(len(m) for m in CONCEPTS.values())


def test_vocabulary_drift(spark):
    old = vocabulary.from_mappings(spark, {"c": {"A": 1, "B": 2, "C": 3}})
    new = vocabulary.from_mappings(spark, {"c": {"A": 1, "B": 5, "D": 4}})
    assert rows(vocabulary.drift(old, new)) == [("c", "B", 2, 5, "changed")]
    every = {(r["source_code"], r["change"]) for r in vocabulary.drift(old, new, changed_only=False).collect()}
    assert every == {("B", "changed"), ("C", "removed"), ("D", "added")}


def test_built_in_vocabulary_has_no_drift_against_itself(spark):
    table = vocabulary.built_in(spark)
    assert vocabulary.drift(table, table, changed_only=False).count() == 0


def test_contract_rules_with_digest(spark, tmp_path):
    text = json.dumps({"expectation_suite_name": "s", "meta": {"a": "b"}, "expectations": [
        {"expectation_type": "x", "kwargs": {"column": "c", "value_set": [1, 2]}},
        {"expectation_type": "y", "kwargs": {}, "meta": {"severity": "WARNING"}},
    ]}, indent=2)
    (tmp_path / "rules.json").write_text(text)
    got = contracts.scan_contracts(spark, str(tmp_path)).orderBy("position").collect()
    assert [(r["expectation_type"], r["column_name"], r["severity"]) for r in got] == [("x", "c", "ERROR"), ("y", None, "WARNING")]
    assert json.loads(got[0]["options"]["value_set"]) == [1, 2]
    assert got[0]["rules_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    one = contracts.load_contract(spark, str(tmp_path / "rules.json"))
    assert one.sha256 == got[0]["rules_sha256"] and one.rules[0].options == {"value_set": [1, 2]}
    with pytest.raises(FileNotFoundError):
        contracts.load_contract(spark, str(tmp_path / "none.json"))


@pytest.mark.parametrize("block_bytes", [files.BLOCK_BYTES, 2])
def test_file_digests(spark, tmp_path, block_bytes):
    contents = {"a.bin": b"", "sp %25 +ace.bin": b"x y", "e +mpty": b"", "b.bin": b"hello", "sub/c.bin": bytes(range(256)) * 5000}
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    manifest = files.file_manifest(spark, str(tmp_path), block_bytes=block_bytes)
    got = {r["path"].rsplit("/", 1)[-1]: (r["length"], r["sha256"]) for r in manifest.collect()}
    assert got == {
        n.rsplit("/", 1)[-1]: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()
    }


def test_digests_of_the_given_tables(spark):
    folder = TESTDATA / "sf0.001"
    got = {r["path"].rsplit("/", 1)[-1]: r["sha256"] for r in files.file_manifest(spark, str(folder)).collect()}
    assert got == {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in folder.glob("*.parquet")}


def test_string_and_binary_digests_agree(spark):
    df = spark.createDataFrame([("héllo", bytearray("héllo".encode()))], "s string, b binary")
    expected = hashlib.sha256("héllo".encode()).hexdigest()
    assert tuple(df.select(files.text_digest("s"), files.text_digest("b")).first()) == (expected, expected)


def test_folder_digest_depends_on_contents_only(spark, tmp_path):
    for folder, names in (("one", "abc"), ("two", "xyz"), ("three", "abc")):
        (tmp_path / folder).mkdir()
        for i, name in enumerate(names):
            (tmp_path / folder / name).write_text("same" if i < 2 else folder[:0] + "other")
    (tmp_path / "three" / "d").write_text("more")
    digests = [data_digest(spark, str(tmp_path / f)) for f in ("one", "two", "three")]
    assert digests[0] == digests[1] != digests[2]
    single = tmp_path / "one" / "a"
    assert data_digest(spark, str(single)) == hashlib.sha256(b"same").hexdigest()


def test_qc_reports(spark, tmp_path):
    (tmp_path / "s1.txt").write_text("PASS\tBasic\ns\nWARN\tx\nPASS\ty\n")
    (tmp_path / "s2.txt").write_text("FAIL\tBasic FAIL\n")
    assert rows(qc.status_rollup(qc.scan_reports(spark, str(tmp_path)))) == [
        ("s1.txt", "PASS", 2), ("s1.txt", "WARN", 1), ("s2.txt", "FAIL", 1),
    ]


def test_vocabulary_listing(spark):
    table = vocabulary.built_in(spark)
    assert vocabulary.query_vocabulary(table).count() == table.count()
    assert rows(vocabulary.query_vocabulary(table, "RACE_to_concept")) == rows(vocabulary.race_concepts(table))
    with pytest.raises(ValueError, match="available: clinvar_to_concept, ethnicity_to_concept"):
        vocabulary.query_vocabulary(table, "drugs")


def test_sources_fall_back_from_a_failed_read(spark, tmp_path):
    broken = tmp_path / "patients.csv.gz"
    broken.write_bytes(b"this is no gzip file")
    good = tmp_path / "patients.csv"
    good.write_text("raw_patient_id,gender,birth_datetime,race,ethnicity\nP9,F,1971-01-01,r,e\n")
    found = delimited.scan_source(spark, "patients", str(tmp_path / "none"), str(broken), str(good))
    assert [r["raw_patient_id"] for r in found.collect()] == ["P9"]
    with pytest.raises(Exception, match="(?i)gzip"):
        delimited.scan_source(spark, "patients", str(broken))
    lacking = tmp_path / "lacking.csv"
    lacking.write_text("raw_patient_id\nP1\n")
    with pytest.raises(ValueError, match="lacks columns"):
        delimited.scan_source(spark, "patients", str(lacking), str(good))


def test_every_document_is_a_file_with_a_digest_of_its_own(spark, tmp_path):
    texts = [(i, f"text {i}\n" * (i % 5)) for i in range(230)] + [(7, "text"), (7, "text"), (None, "ä"), (8, None), (-3, "")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wanted = [(i, f"{t or ''}\n".encode()) for i, t in texts]
    got = [tuple(r) for r in workload.QUERIES["file_sha256_manifest"](spark, str(tmp_path)).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(got, key=order) == sorted(((i, len(b), hashlib.sha256(b).hexdigest()) for i, b in wanted), key=order)


def test_write_each_without_rows(spark, tmp_path):
    assert files.write_each(spark.createDataFrame([], "id bigint, text string"), str(tmp_path), "id", "text") == []
    assert files.file_manifest(spark, []).collect() == []


def test_vocabulary_documents_of_one_task_are_parsed_by_many(spark):
    documents = [(json.dumps({"a": {f"c{i}": i, "_r": 1}}),) for i in range(40)]
    one = spark.createDataFrame(documents, "value string").coalesce(1)
    entries = vocabulary.entries_of(one)
    assert rows(entries, "concept_id") == [("a", f"c{i}", i) for i in range(40)]
    assert entries.select(F.spark_partition_id()).distinct().count() > 1
    drifted = vocabulary.drift(entries, entries.withColumn("concept_id", F.col("concept_id") + 1))
    assert drifted.count() == 40 and "Broadcast" not in drifted._jdf.queryExecution().executedPlan().toString()
