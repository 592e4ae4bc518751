"""Table store, whole jobs, command lines, streams."""

from __future__ import annotations

import json
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.fixed_values import BRONZE_COLUMNS
from clinlake.operators import contracts, ledger, omop, silver
from clinlake.plans import audit_job, governance_job, omop_job
from clinlake.sinks.tables import TableStore, cluster_rows, inferred_cluster_keys
from clinlake.streaming.adapters import split_stream, upsert_stream
from clinlake.workspace import scratch_path, shared_root
from tests.conftest import rows

PATIENTS = """raw_patient_id,gender,birth_datetime,race,ethnicity,state,zip_code
P1,MALE,1951-02-09 23:41:10,BLACK,HISPANIC,VT,71
P2,FEMALE,2004-07-30,OTHER,NOT_HISPANIC,ID,72
P3,,1969-10-12 05:05:05,ASIAN,NOT_HISPANIC,UT,73
P4,blue,day before yesterday,none,none,??,74
"""
DIAGNOSES = """encounter_id,raw_patient_id,diagnosis_date,icd10_code,diagnosis_description,condition_type
E1,P1,2011-08-01 07:15:00,E11.9,sugar,A
E2,P1,2011-08-02 19:45:00,Q00,unheard of,A
E3,P2,some day,I10,pressure,B
"""
LABS = """lab_event_id,raw_patient_id,lab_datetime,loinc_code,test_name,numeric_value,unit_value,ref_range,flag
L1,P1,2012-12-24 18:30:00,4548-4,first,61.25,u1,0-99,ok
L2,P2,2013-01-06,2093-3,second,traces,u2,none,odd
"""
VCF = (
    "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tPATIENT_ID\tSAMPLE_ID\n"
    "chr3\t5501\tv1\tG\tGCC\t71.5\tPASS\tGENE=ABC1;CLNSIG=Pathogenic;AF=0.25\tP1\tS1\n"
    "chr9\t88\tv2\tA\tC\t3.0\tq10\tGENE=DEF2;CLNSIG=Benign\tP2\tS2\n"
)


@pytest.fixture
def data_dir(tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    for name, text in zip(omop_job.SOURCE_FILES.values(), (PATIENTS, DIAGNOSES, LABS, VCF), strict=True):
        (folder / name).write_text(text)
    return str(folder)


# -- table store --------------------------------------------------------------------


def test_every_write_mode(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    one, two = (spark.createDataFrame([(i,)], "a int") for i in (1, 2))
    writers = {"silver": store.write_silver, "gold": store.write_gold}
    for tier, write in writers.items():
        write(one, "t", mode="error")
        write(two, "t", mode="ignore")
        assert rows(store.read(tier, "t")) == [(1,)]
        with pytest.raises(FileExistsError):
            write(two, "t", mode="errorifexists")
        with pytest.raises(ValueError):
            write(two, "t", mode="Overwrite!")
        assert rows(store.read(tier, "t")) == [(1,)]
        write(two, "t", mode="append")
        assert rows(store.read(tier, "t")) == [(1,), (2,)]
        write(two, "t")
        assert rows(store.read(tier, "t")) == [(2,)]
    with pytest.raises(ValueError):
        store.write_quarantine(one, mode="")


def test_upsert_leaves_untouched_buckets_alone(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    base = spark.range(200).selectExpr("id AS k", "id * 2 AS v", "IF(id = 7, NULL, 'x') AS note")
    assert store.upsert_touched(base, "t", ["k"], buckets=8) == list(range(8))
    files = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("part-*.parquet") if "commits" not in str(f)}
    change = spark.createDataFrame([(3, -1, "new"), (3, -2, "new"), (None, 5, "none")], "k bigint, v bigint, note string")
    touched = store.upsert_touched(change, "t", ["k"], latest_by=["v"])
    assert 1 <= len(touched) <= 2
    after = {f for f in tmp_path.rglob("part-*.parquet") if "commits" not in str(f)}
    kept = {f for f in files if not any(f"={b}/" in str(f) for b in touched)}
    assert kept <= after and all(f.stat().st_mtime_ns == files[f] for f in kept)
    assert not (set(files) - kept) & after
    again = store.upsert_touched(change, "t", ["k"], latest_by=["v"])
    assert again == touched
    found = {r["k"]: r["v"] for r in store.read("gold", "t").collect()}
    assert found == {i: i * 2 for i in range(200)} | {3: -1, None: 5} and store.read("gold", "t").columns == ["k", "v", "note"]
    assert store.upsert_touched(change.where("false"), "t", ["k"]) == []
    store.write_gold(base, "plain", cluster_by=["k"])
    with pytest.raises(ValueError):
        store.upsert_touched(change, "plain", ["k"])


def test_clustered_write_with_a_map_at_any_depth(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    df = spark.sql("SELECT id, map('k', id) AS m, struct(map('k', id) AS n) AS s, array(map('k', id)) AS a FROM range(5)")
    store.write_gold(df, "maps", cluster_by=["id"])
    assert [r["s"]["n"] for r in store.read("gold", "maps").orderBy("id").collect()] == [{"k": i} for i in range(5)]


def test_versions_and_schema_evolution(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.read("gold", "person")
    store.write_silver(spark.createDataFrame([(1,)], "a int"), "T")
    store.write_silver(spark.createDataFrame([(2, "x")], "a int, b string"), "T", mode="append")
    assert rows(store.read("silver", "t")) == [(1, None), (2, "x")]
    with pytest.raises(ValueError):
        store.write_silver(spark.createDataFrame([(3, 1)], "a int, c int"), "T", "append", merge_schema=False)
    store.write_silver(spark.createDataFrame([(9,)], "a int"), "T")
    assert rows(store.read("silver", "T")) == [(9,)] and rows(store.read("silver", "T", version=0)) == [(1, None), (2, "x")]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write_silver(spark.createDataFrame([(1,)], "a int"), "t")
    broken = tmp_path / "silver" / "t" / "v=1"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("half")
    assert rows(store.read("silver", "t")) == [(1,)]
    store.write_silver(spark.createDataFrame([(2,)], "a int"), "t")
    assert store.versions("silver", "t") == [0, 2] and rows(store.read("silver", "t")) == [(2,)]


def test_appends_are_seen_whole_or_not_at_all(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write_silver(spark.createDataFrame([(1,)], "a int"), "t")
    store.write_silver(spark.createDataFrame([(2, "x")], "a int, `b c` string"), "t", mode="append")
    half = tmp_path / "silver" / "t" / "v=0+1"
    spark.createDataFrame([(9, "half")], "a int, `b c` string").write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert rows(store.read("silver", "t")) == [(1, None), (2, "x")]
    store.write_silver(spark.createDataFrame([(3,)], "a int"), "t", mode="append")
    assert rows(store.read("silver", "t")) == [(1, None), (2, "x"), (3, None)]
    assert store.compact("silver", "t").where("status = 'before'").first()["num_files"] >= 3
    assert rows(store.read("silver", "t")) == [(1, None), (2, "x"), (3, None)]
    assert store.prune_versions("silver", "t", keep=1, older_than_hours=0) == [0]
    assert [p.name for p in (tmp_path / "silver" / "t").iterdir() if p.name.startswith("v=")] == ["v=1"]


def test_cluster_keys_follow_the_columns(spark):
    def keys(*names):
        return inferred_cluster_keys(spark.createDataFrame([], ", ".join(f"{n} int" for n in names)))

    assert keys("person_id", "condition_concept_id") == ["person_id", "condition_concept_id"]
    assert keys("measurement_concept_id", "person_id") == ["person_id", "measurement_concept_id"]
    assert keys("person_id", "x") == ["person_id"] and keys("x") == []


def test_clustering_cuts_a_hot_key_into_several_partitions(spark):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 7, id) AS person_id", "id AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [
            (r["p"], r["n"], r["lo"], r["hi"])
            for r in cluster_rows(df, ["person_id"], 12)
            .groupBy(F.spark_partition_id().alias("p"))
            .agg(F.count("*").alias("n"), F.min("person_id").alias("lo"), F.max("person_id").alias("hi"))
            .orderBy("p").collect()
        ]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(n for _, n, _, _ in sizes) < 30_000 / 6 and sum(n for _, n, _, _ in sizes) == 30_000
    assert all(a[3] <= b[2] for a, b in zip(sizes, sizes[1:], strict=False))


def test_upsert_is_idempotent_and_first_load_is_deduplicated(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first = spark.createDataFrame([(1, 5), (1, 6), (2, 1)], "person_id int, v int")
    store.upsert_gold(first, "person", ["person_id"], latest_by=["v"])
    assert rows(store.read("gold", "person")) == [(1, 6), (2, 1)]
    second = spark.createDataFrame([(2, 9), (3, 3)], "person_id int, v int")
    for _ in range(2):
        store.upsert_gold(second, "person", ["person_id"])
    assert rows(store.read("gold", "person")) == [(1, 6), (2, 9), (3, 3)]


def test_compaction_telemetry_and_pruning(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write_gold(spark.range(1000).selectExpr("id AS person_id").repartition(6), "person", cluster_by=[], user_metadata="m")
    stats = {r["status"]: r for r in store.compact("gold", "person", ["person_id"], files=2).collect()}
    assert (stats["before"]["num_files"], stats["after"]["num_files"]) == (6, 2)
    told = store.telemetry("gold", "person").first()
    assert told["status"] == "AVAILABLE" and told["num_files"] == 2 and told["bytes"] > 0
    assert told["clustering_columns"] == ["person_id"]
    assert [c["operation"] for c in told["recent_commits"]] == ["COMPACT", "OVERWRITE"]
    assert told["recent_commits"][1]["user_metadata"] == "m"
    assert store.prune_versions("gold", "person", keep=1) == []
    assert store.prune_versions("gold", "person", keep=1, older_than_hours=0) == [0]
    assert store.read("gold", "person").count() == 1000
    assert told["notice"] is None
    missing = store.telemetry("gold", "nothing").first()
    assert missing["status"] == "NOT_FOUND" and missing["num_files"] is None and missing["recent_commits"] == []
    with pytest.raises(FileNotFoundError):
        store.compact("gold", "nothing")


def test_telemetry_without_a_commit_log(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    spark.range(3).write.parquet(f"{tmp_path}/gold/t/v=0")
    told = store.telemetry("gold", "t").first()
    assert told["status"] == "TELEMETRY_UNAVAILABLE" and told["notice"]


def test_named_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), schema="default")
    store.write_silver(spark.createDataFrame([(1,)], "a int"), "named_t")
    assert spark.table("default.silver_named_t").count() == 1
    store.write_silver(spark.createDataFrame([(1, 2), (3, 4)], "a int, b int"), "named_t")
    assert spark.table("default.silver_named_t").columns == ["a", "b"]
    store.write_silver(spark.createDataFrame([(5, 6, "x")], "a int, b int, c string"), "named_t", "append")
    assert rows(spark.table("default.silver_named_t")) == [(1, 2, None), (3, 4, None), (5, 6, "x")]
    spark.sql("DROP TABLE default.silver_named_t")


def test_other_formats(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), fmt="orc")
    store.write_quarantine(spark.createDataFrame([(1,)], "a int"))
    assert rows(store.read("silver", "quarantine_records")) == [(1,)]


def test_scratch_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == configured
    first = scratch_path(spark, "x")
    assert first.startswith(f"{configured}/x-") and first != scratch_path(spark, "x")


class Session:
    """As much of a session as the choice of the scratch folder looks at."""

    def __init__(self, master):
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")
        self.conf = SimpleNamespace(get=lambda key, default: default)


def test_only_a_local_session_gets_a_temporary_folder():
    assert shared_root(Session("local[2]")).startswith(tempfile.gettempdir())
    with pytest.raises(RuntimeError):
        shared_root(Session("spark://host:7077"))


# -- jobs ---------------------------------------------------------------------------


def test_lazy_build(spark, data_dir):
    result = omop_job.build_omop(spark, omop_job.scan_sources(spark, data_dir))
    counts = {r["table_name"]: (r["rows"], r["persons"], r["mapped_rows"]) for r in omop_job.gold_counts(result.gold).collect()}
    assert counts == {"person": (2, 2, 2), "condition_occurrence": (2, 1, 1), "measurement": (3, 2, 3)}
    assert all(g.success for g in result.gates.values()) and set(result.gates) == set(result.gold)


def test_saved_build_counts_and_reload(spark, data_dir, tmp_path):
    out = str(tmp_path / "lake")
    bronze = omop_job.scan_sources(spark, data_dir)
    result = omop_job.build_omop(spark, bronze, out, maintain=True)
    assert result.counts == {
        "patients": {"accepted": 2, "quarantined": 2}, "diagnoses": {"accepted": 2, "quarantined": 1},
        "labs": {"accepted": 2, "quarantined": 0}, "variants": {"accepted": 1, "quarantined": 1},
    }
    store = TableStore(spark, out)
    rejected = store.read("silver", "quarantine_clinical")
    assert sorted(r["raw_patient_id"] for r in rejected.collect()) == ["P3", "P4"]
    assert store.current_path("silver", "quarantine_labs") is None
    before = rows(result.gold["measurement"])
    again = omop_job.build_omop(spark, bronze, out, load_mode="upsert")
    assert rows(again.gold["measurement"]) == before and again.gold["person"].count() == 2


def test_contract_gate_can_stop_the_build(spark, data_dir, tmp_path):
    rules = tmp_path / "rules.json"
    rules.write_text(json.dumps({"expectations": [
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "year_of_birth", "value_set": [1]}}
    ]}))
    bronze = omop_job.scan_sources(spark, data_dir)
    warned = omop_job.build_omop(spark, bronze, contract_path=str(rules))
    assert not warned.gates["person"].success
    with pytest.raises(contracts.ContractBreach):
        omop_job.build_omop(spark, bronze, str(tmp_path / "lake"), on_fail="fail", contract_path=str(rules))
    assert TableStore(spark, str(tmp_path / "lake")).current_path("gold", "person") is None


def test_build_with_another_vocabulary(spark, data_dir, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"gender_to_concept": {"MALE": 1, "FEMALE": 2}}))
    result = omop_job.build_omop(
        spark, omop_job.scan_sources(spark, data_dir), vocabulary=str(tmp_path / "v.json"), enforce_contracts=False
    )
    assert sorted(r["gender_concept_id"] for r in result.gold["person"].collect()) == [1, 2]
    assert result.gates == {}


def test_build_options_are_checked(spark, data_dir):
    with pytest.raises(ValueError):
        omop_job.build_omop(spark, {}, load_mode="merge")
    with pytest.raises(ValueError):
        omop_job.check_gold({}, None, on_fail="maybe")


def test_omop_command_line(spark, data_dir, tmp_path, capsys, monkeypatch):
    monkeypatch.setenv("DATA_DIR", "/nowhere")
    omop_job.main(["--data-dir", data_dir, "--output-dir", str(tmp_path / "lake"), "--run-maintenance"])
    assert "patients: 2 accepted, 2 quarantined" in capsys.readouterr().out
    omop_job.main(["--data-dir", data_dir, "--no-save", "--no-enforce-contracts"])
    with pytest.raises(SystemExit):
        omop_job.main(["--data-dir", data_dir])


PERSON_CSV = (
    "person_id,gender_concept_id,year_of_birth,birth_datetime,race_concept_id,ethnicity_concept_id\n"
    "77,8532,2004,2004-07-30T01:02:03Z,8516,38003563\n78,8507,1951,1951-02-09T23:41:10Z,8515,38003564\n"
)


def test_governed_run_is_recorded_and_audited(spark, tmp_path, capsys):
    data = tmp_path / "person.csv"
    data.write_text(PERSON_CSV)
    path = str(tmp_path / "ledger")
    gate = governance_job.main([str(data), "--ledger", path])
    assert gate.success and gate.evaluated_expectations == 4
    assert "4 of 4 rules" in capsys.readouterr().out
    run = ledger.read_ledger(spark, path).first()
    assert run["params"]["data_sha256"] == governance_job.data_digest(spark, str(data))
    assert set(run["metrics"]) == {
        "total_records_ingested", "evaluated_expectations", "successful_expectations",
        "unsuccessful_expectations", "expectation_success_rate", "gxp_gate_passed",
    }
    reports = audit_job.main(["--run-id", run["run_id"], "--ledger", path, "--output", str(tmp_path / "reports")])
    assert reports.first()["compliance_status"] == "COMPLIANT"


def test_audit_command_line_with_signoff(spark, tmp_path, capsys):
    audit = ["--table-path", str(tmp_path / "nothing"), "--enable-signoff"]
    assert audit_job.main(audit).first()["compliance_status"] == "NON_COMPLIANT"
    assert "waiting for a sign-off" in capsys.readouterr().out
    given = {"audit_id": f"|{tmp_path}/nothing", "operator_id": "qa", "decision": "OVERRIDE", "justification": "x"}
    (tmp_path / "signoffs.json").write_text(json.dumps(given))
    signed = audit_job.main([*audit, "--signoffs", str(tmp_path / "signoffs.json")])
    assert signed.first()["compliance_status"] == "APPROVED_BY_QA"
    assert "waiting" not in capsys.readouterr().out


def test_strict_run_is_recorded_before_it_raises(spark, tmp_path):
    data = tmp_path / "person.csv"
    data.write_text(PERSON_CSV.replace("8507", "1"))
    path = str(tmp_path / "ledger")
    with pytest.raises(contracts.ContractBreach):
        governance_job.govern(spark, str(data), ledger_path=path, strict=True)
    assert ledger.read_ledger(spark, path).first()["metrics"]["gxp_gate_passed"] == 0.0


def test_in_memory_runs_say_so(spark, tmp_path):
    path = str(tmp_path / "ledger")
    governance_job.evaluate(spark, spark.range(1), ledger_path=path, run_id="r1")
    run = ledger.read_ledger(spark, path).first()
    assert run["run_id"] == "r1" and run["params"]["data_sha256"] == "in_memory_dataframe"


# -- streams ------------------------------------------------------------------------


def stream_of_patients(spark, folder):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in BRONZE_COLUMNS["patients"]])
    return silver.parse_patients(spark.readStream.schema(schema).option("header", True).csv(str(folder)))


def test_transforms_and_split_on_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(PATIENTS)
    paths = [str(tmp_path / n) for n in ("accepted", "rejected", "checkpoint")]

    def drain():
        query = split_stream(
            stream_of_patients(spark, folder), silver.patient_is_valid(), *paths, transform=omop.person
        )
        assert query.awaitTermination(120)

    drain()
    (folder / "b.csv").write_text(PATIENTS.replace("P", "Q"))
    drain()
    drain()
    accepted = spark.read.parquet(paths[0])
    assert sorted(r["person_source_value"] for r in accepted.collect()) == ["P1", "P2", "Q1", "Q2"]
    assert spark.read.parquet(paths[1]).count() == 4


def test_upserts_from_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    store = TableStore(spark, str(tmp_path / "lake"))
    for batch in ([(1, 1), (2, 1)], [(2, 5), (3, 5)]):
        spark.createDataFrame(batch, "person_id int, v int").coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema("person_id int, v int").parquet(str(folder))
        query = upsert_stream(stream, store, "person", ["person_id"], str(tmp_path / "checkpoint"), ["v"])
        assert query.awaitTermination(120)
    assert rows(store.read("gold", "person")) == [(1, 1), (2, 5), (3, 5)]
