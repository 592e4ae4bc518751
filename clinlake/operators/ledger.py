"""Run ledger: one row per pipeline run, appended to a table and never changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_LAYOUT = (
    "run_id string, experiment string, run_name string, status string, start_time timestamp, "
    "end_time timestamp, params map<string,string>, metrics map<string,double>, "
    "tags map<string,string>, artifacts array<string>"
)


def append_runs(runs: DataFrame, path: str) -> None:
    """Append runs to the ledger table at ``path``."""
    runs.write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_LAYOUT).parquet(path)


def latest_run(
    ledger: DataFrame, by: Sequence[str] = ("experiment",), run_id: str = "run_id"
) -> DataFrame:
    """The newest run of every experiment; the greater id wins a tie.

    An aggregate with map-side pre-aggregation, so an experiment with very many runs
    costs no task more than one row per partition.
    """
    order = F.struct("start_time", run_id)
    newest = ledger.groupBy(*by).agg(F.max_by(F.struct(*ledger.columns), order).alias("run"))
    return newest.select("run.*")


def run_state(runs: DataFrame) -> DataFrame:
    """Runs with their gate result as columns; a rate that was not logged is 0."""
    gate = F.coalesce(F.col("metrics")["gxp_gate_passed"] == 1.0, F.lit(False))
    rate = F.coalesce(F.col("metrics")["expectation_success_rate"], F.lit(0.0))
    return runs.withColumns({"gxp_gate_passed": gate, "expectation_success_rate": rate})


def run_evidence(requested: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows of requested runs; runs the ledger does not know are ``ERROR``."""
    ids = requested.select("run_id").where(F.col("run_id").isNotNull()).distinct()
    rows = latest_run(ledger.join(ids, "run_id", "left_semi"), by=["run_id"])
    marked = rows.withColumn("_known", F.lit(True))
    joined = ids.join(marked, "run_id", "left")
    state = F.when(F.col("_known"), "COLLECTED").otherwise("ERROR")
    return joined.withColumn("run_evidence", state).drop("_known")


def experiment_state(requested: DataFrame, ledger: DataFrame) -> DataFrame:
    """State of the newest run of each requested experiment; ``NO_RUNS`` where there is none."""
    names = requested.select("experiment").where(F.col("experiment").isNotNull()).distinct()
    newest = run_state(latest_run(ledger.join(names, "experiment", "left_semi")))
    joined = names.join(newest, "experiment", "left")
    return joined.withColumns(
        {
            "status": F.coalesce("status", F.lit("NO_RUNS")),
            "gxp_gate_passed": F.coalesce("gxp_gate_passed", F.lit(False)),
            "expectation_success_rate": F.coalesce("expectation_success_rate", F.lit(0.0)),
        }
    )
