"""Sinks, upsert, de-duplication, snapshot difference and maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinlake.functions.lookup import text_bytes
from clinlake.operators import merge, silver
from clinlake.sinks.tables import TableStore
from clinlake.workspace import scratch_path
from workload.catalog import plain, query, table, view
from workload.q_columns import D, P, PATIENT_OK
from workload.q_omop import PERSON_SQL, gold


def store(spark, label="lake"):
    return TableStore(spark, scratch_path(spark, label))


@query(
    "silver_roundtrip",
    "SELECT raw_patient_id, gender, birth_datetime, race, ethnicity, CAST(NULL AS VARCHAR) AS reason "
    f"FROM bronze_patients WHERE {PATIENT_OK} UNION ALL "
    f"SELECT raw_patient_id, gender, birth_datetime, race, ethnicity, 'late' FROM bronze_patients WHERE NOT {PATIENT_OK}",
    P,
)
def silver_roundtrip(spark, sf_dir):
    """Overwrite, then append rows with one more column; both schemas are read as one."""
    lake = store(spark)
    sides = silver.silver_patients(view(spark, sf_dir, "bronze_patients"))
    lake.write_silver(sides.accepted.drop("parsed_birth_dt"), "demographics")
    late = sides.rejected.drop("parsed_birth_dt").withColumn("reason", F.lit("late"))
    lake.write_silver(late, "demographics", mode="append")
    return lake.read("silver", "demographics")


@query(
    "quarantine_roundtrip",
    "SELECT raw_patient_id, gender, CAST(NULL AS VARCHAR) AS encounter_id, CAST(NULL AS VARCHAR) AS diagnosis_date "
    f"FROM bronze_patients WHERE NOT {PATIENT_OK} UNION ALL "
    "SELECT raw_patient_id, NULL, encounter_id, diagnosis_date FROM bronze_diagnoses "
    "WHERE TRY_CAST(diagnosis_date AS DATE) IS NULL",
    P + D,
)
def quarantine_roundtrip(spark, sf_dir):
    lake = store(spark)
    patients = silver.silver_patients(view(spark, sf_dir, "bronze_patients")).rejected
    diagnoses = silver.silver_diagnoses(view(spark, sf_dir, "bronze_diagnoses")).rejected
    lake.write_quarantine(patients.select("raw_patient_id", "gender"))
    lake.write_quarantine(diagnoses.select("raw_patient_id", "encounter_id", "diagnosis_date"))
    return lake.read("silver", "quarantine_records")


@query("clustered_write", PERSON_SQL, P)
def clustered_write(spark, sf_dir):
    lake = store(spark)
    lake.write_gold(gold(spark, sf_dir)["person"], "person", user_metadata="workload")
    return plain(lake.read("gold", "person"))


@query(
    "named_table",
    "SELECT c_mktsegment, count(*) AS customers, sum(c_custkey) AS keys FROM customer GROUP BY c_mktsegment",
    longs=("keys",),
)
def named_table(spark, sf_dir):
    """Write under a catalog name and query that name with SQL."""
    lake = TableStore(spark, scratch_path(spark, "named"), schema="default")
    name = "customer_" + lake.base_path.rsplit("-", 1)[-1]
    lake.write_silver(table(spark, sf_dir, "customer"), name)
    answer = spark.sql(
        f"SELECT c_mktsegment, count(*) AS customers, sum(c_custkey) AS keys "
        f"FROM default.silver_{name} GROUP BY c_mktsegment"
    )
    answer.schema  # resolved against the name before its entry goes; the files stay
    spark.sql(f"DROP TABLE default.silver_{name}")
    return answer


@query(
    "compact_table",
    "SELECT o_orderstatus, count(*) AS orders, sum(o_orderkey) AS keys, true AS fewer_files "
    "FROM orders GROUP BY o_orderstatus",
    longs=("keys",),
)
def compact_table(spark, sf_dir):
    """Rows of a compacted table, and whether it has fewer files than before."""
    lake = store(spark)
    lake.write_silver(table(spark, sf_dir, "orders").repartition(16, "o_orderkey"), "orders")
    files = {r["status"]: r["num_files"] for r in lake.compact("silver", "orders").collect()}
    return lake.read("silver", "orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"),
        F.sum("o_orderkey").alias("keys"),
        F.lit(files["after"] < files["before"]).alias("fewer_files"),
    )


@query(
    "table_telemetry",
    "SELECT 'AVAILABLE' AS status, 'parquet' AS format, 'person_id' AS clustering_columns, "
    "'UPSERT,OVERWRITE' AS recent_operations, true AS has_files, count(*) AS rows FROM "
    f"({PERSON_SQL})",
    P,
)
def table_telemetry(spark, sf_dir):
    lake = store(spark)
    people = gold(spark, sf_dir)["person"]
    lake.write_gold(people, "person")
    lake.upsert_gold(people, "person", ["person_id"])
    told = lake.telemetry("gold", "person").first()
    return lake.read("gold", "person").agg(
        F.count("*").alias("rows"),
        F.lit(told["status"]).alias("status"),
        F.lit(told["format"]).alias("format"),
        F.lit(",".join(told["clustering_columns"])).alias("clustering_columns"),
        F.lit(",".join(c["operation"] for c in told["recent_commits"])).alias("recent_operations"),
        F.lit(told["num_files"] > 0 and told["bytes"] > 0).alias("has_files"),
    )


# -- upsert and difference ---------------------------------------------------------

TARGET_COLUMNS = "o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS changed_at"
SOURCE_COLUMNS = "l_orderkey * 2 AS order_key, l_linestatus AS status, l_extendedprice AS price, l_shipdate AS changed_at"
SURVIVORS = (
    f"SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY "
    "changed_at DESC NULLS LAST, status DESC NULLS LAST, price DESC NULLS LAST) AS n "
    f"FROM (SELECT {SOURCE_COLUMNS} FROM lineitem)) WHERE n = 1"
)


def target(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*TARGET_COLUMNS.split(", "))


def changes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(*SOURCE_COLUMNS.split(", "))


@query("dedup_keys", SURVIVORS)
def dedup_keys(spark, sf_dir):
    return merge.dedup_keys(changes(spark, sf_dir), ["order_key"], ["changed_at"])


@query(
    "upsert_scd1",
    f"SELECT * FROM ({SURVIVORS}) UNION ALL SELECT {TARGET_COLUMNS} FROM orders "
    "WHERE o_orderkey NOT IN (SELECT l_orderkey * 2 FROM lineitem)",
)
def upsert_scd1(spark, sf_dir):
    return merge.upsert(target(spark, sf_dir), changes(spark, sf_dir), ["order_key"], ["changed_at"])


TOUCHED_BUCKETS = 64


@query(
    "upsert_touched_only",
    "SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice + CASE WHEN o_orderkey = (SELECT max(o_orderkey) "
    "FROM orders) THEN 1.0E0 ELSE 0.0E0 END AS price, 1 AS buckets_rewritten FROM orders",
)
def upsert_touched_only(spark, sf_dir):
    """One changed order: one of the table's key buckets is rewritten."""
    lake = store(spark)
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS order_key", "o_orderstatus AS status", "o_totalprice AS price")
    lake.upsert_touched(orders, "orders", ["order_key"], buckets=TOUCHED_BUCKETS)
    newest = orders.agg(F.max("order_key").alias("order_key"))
    change = orders.join(newest, "order_key").withColumn("price", F.col("price") + F.lit(1.0))
    touched = lake.upsert_touched(change, "orders", ["order_key"])
    return lake.read("gold", "orders").withColumn("buckets_rewritten", F.lit(len(touched)))


@query(
    "upsert_growing",
    "SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice + CASE WHEN o_orderkey = (SELECT max(o_orderkey) "
    "FROM orders) THEN 1.0E0 ELSE 0.0E0 END AS price, true AS first_is_one_bucket, true AS grew_by_splits, "
    "1 AS last_rewritten FROM orders",
)
def upsert_growing(spark, sf_dir):
    """A table that starts with ten orders in one bucket and splits bucket by bucket until it holds all of them."""
    lake = store(spark)
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS order_key", "o_orderstatus AS status", "o_totalprice AS price")
    size = max(1, text_bytes(orders) // 24)
    third = F.pmod(F.xxhash64("order_key"), F.lit(3))
    newest = orders.join(orders.agg(F.max("order_key").alias("order_key")), "order_key")
    loads = [
        orders.orderBy("order_key").limit(10), orders.where(third == 0), orders.where(third < 2), orders,
        newest.withColumn("price", F.col("price") + F.lit(1.0)),
    ]
    written = [lake.upsert_touched(rows, "orders", ["order_key"], bucket_bytes=size) for rows in loads]
    counts = [max(w) + 1 for w in written[:-1]]
    return lake.read("gold", "orders").withColumns({
        "first_is_one_bucket": F.lit(written[0] == [0]), "grew_by_splits": F.lit(counts == sorted(set(counts)) and counts[-1] > 8),
        "last_rewritten": F.lit(len(written[-1])),
    })


NEW_KEY = "o_orderkey + CASE WHEN o_orderkey % 10 = 0 THEN 1000000000000 ELSE 0 END"
NEW_PRICE = "o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 1.0E0 ELSE 0.0E0 END"


@query(
    "snapshot_diff",
    "SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS price, 'delete' AS change_type "
    "FROM orders WHERE o_orderkey % 10 = 0 UNION ALL "
    f"SELECT {NEW_KEY}, o_orderstatus, {NEW_PRICE}, 'insert' FROM orders WHERE o_orderkey % 10 = 0 UNION ALL "
    "SELECT o_orderkey, o_orderstatus, o_totalprice, 'update_preimage' FROM orders "
    "WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0 UNION ALL "
    f"SELECT o_orderkey, o_orderstatus, {NEW_PRICE}, 'update_postimage' FROM orders "
    "WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0",
)
def snapshot_diff(spark, sf_dir):
    """Every tenth order gets another key, every seventh another price."""
    orders = table(spark, sf_dir, "orders")
    old = orders.selectExpr("o_orderkey AS order_key", "o_orderstatus AS status", "o_totalprice AS price")
    new = orders.selectExpr(f"{NEW_KEY} AS order_key", "o_orderstatus AS status", f"{NEW_PRICE} AS price")
    return merge.snapshot_diff(old, new, ["order_key"])


HOT_KEY = "CASE WHEN l_linenumber = 1 THEN 0 ELSE l_orderkey END"


@query(
    "snapshot_diff_hot_key",
    f"SELECT {HOT_KEY} AS order_key, l_orderkey AS n, l_suppkey AS v, 'update_preimage' AS change_type FROM lineitem UNION ALL "
    f"SELECT {HOT_KEY}, l_orderkey, l_suppkey + 1000000, 'update_postimage' FROM lineitem",
)
def snapshot_diff_hot_key(spark, sf_dir):
    """Every row changes, and a quarter of all rows has one key."""
    old = table(spark, sf_dir, "lineitem").selectExpr(f"{HOT_KEY} AS order_key", "l_orderkey AS n", "l_suppkey AS v")
    new = old.withColumn("v", (F.col("v") + 1000000).cast(old.schema["v"].dataType))
    return merge.snapshot_diff(old, new, ["order_key"], hot_rows=1000)


@query(
    "clustered_by_curve",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, true AS few_files_by_first, true AS few_files_by_second FROM lineitem",
)
def clustered_by_curve(spark, sf_dir):
    """Lines clustered by order and part: a narrow range of either column lies in a part of the files."""
    lake = store(spark)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    lake.write_gold(rows, "lines", cluster_by=["l_orderkey", "l_partkey"], partitions=64)
    written = lake.read("gold", "lines")
    files = written.groupBy("_metadata.file_name").agg(
        *[f(c).alias(f"{name}_{c}") for c in ("l_orderkey", "l_partkey") for name, f in (("lo", F.min), ("hi", F.max))]
    )
    middle = {c: written.approxQuantile(c, [0.5], 0.01)[0] for c in ("l_orderkey", "l_partkey")}
    touched = files.agg(
        *[F.avg(F.lit(at).between(F.col(f"lo_{c}"), F.col(f"hi_{c}")).cast("int")).alias(c) for c, at in middle.items()]
    ).first()
    return written.withColumns({
        "few_files_by_first": F.lit(touched["l_orderkey"] < 0.4), "few_files_by_second": F.lit(touched["l_partkey"] < 0.4),
    })
