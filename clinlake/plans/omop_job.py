"""Bronze -> silver -> gold: the whole OMOP build.

Without an output path the gold tables are lazy frames over the sources. With one,
every tier is written once, later steps read what was written, and the accept and
quarantine counts come from the writes themselves.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clinlake.fixed_values import CLUSTER_KEYS, CONCEPTS, PRIMARY_KEYS
from clinlake.operators import omop, silver
from clinlake.operators.contracts import ContractBreach, GateResult, run_gate
from clinlake.sinks.tables import TableStore, partitions_for
from clinlake.sources.contracts import Contract, contract_of, load_contract
from clinlake.sources.delimited import scan_source
from clinlake.sources.vcf import scan_vcf
from clinlake.sources.vocabulary import ROW_LAYOUT, category, load_vocabulary, vocabulary_path
from clinlake.workspace import scratch_path

# File names of the sources inside a data folder.
SOURCE_FILES = {
    "patients": "clinical_patients.csv",
    "diagnoses": "clinical_diagnoses.csv",
    "labs": "lab_measurements.csv",
    "variants": "genomic_variants.vcf",
}
# Silver sources that each gold table is built from.
GOLD_SOURCES = {
    "person": ("patients",),
    "condition_occurrence": ("diagnoses",),
    "measurement": ("labs", "variants"),
}
# Names of the silver tables.
SILVER_TABLES = {
    "patients": "clinical_demographics",
    "diagnoses": "clinical_diagnoses",
    "labs": "lab_measurements",
    "variants": "genomic_variants",
}
QUARANTINE_TABLES = {
    "patients": "quarantine_clinical",
    "diagnoses": "quarantine_diagnoses",
    "labs": "quarantine_labs",
    "variants": "quarantine_variants",
}


@dataclass
class OmopResult:
    gold: dict[str, DataFrame]
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    gates: dict[str, GateResult] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)


def scan_sources(
    spark: SparkSession,
    data_dir: str,
    export: str = "canonical",
    overrides: Mapping[str, str] | None = None,
    max_variants: int | None = None,
    as_of: datetime | None = None,
) -> dict[str, DataFrame]:
    """Bronze frames; a path in ``overrides`` is tried before the data folder's file."""
    given = overrides or {}
    local = {name: f"{data_dir.rstrip('/')}/{file}" for name, file in SOURCE_FILES.items()}

    def paths(name: str) -> list[str]:
        return [p for p in (given.get(name), local[name]) if p]

    frames = {
        name: scan_source(spark, name, *paths(name), export=export, as_of=as_of)
        for name in ("patients", "diagnoses", "labs")
    }
    frames["variants"] = scan_vcf(
        spark, *paths("variants"), max_rows=max_variants, as_of=as_of
    )
    return frames


def parse_sources(bronze: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, Column]]:
    """Parsed rows and accept predicate of every source."""
    return {
        "patients": (silver.parse_patients(bronze["patients"]), silver.patient_is_valid()),
        "diagnoses": (silver.parse_diagnoses(bronze["diagnoses"]), silver.diagnosis_is_valid()),
        "labs": (silver.parse_labs(bronze["labs"]), silver.lab_is_valid()),
        "variants": (bronze["variants"], silver.variant_is_valid()),
    }


def gold_tables(
    silver_rows: Mapping[str, DataFrame],
    mappings: Mapping[str, Mapping[str, int] | DataFrame] | None = None,
    key_style: str = "masked",
) -> dict[str, DataFrame]:
    """The three gold tables of accepted silver rows; projections only, no shuffle."""
    known = mappings or {}
    return {
        "person": omop.person(
            silver_rows["patients"],
            known.get("gender_to_concept"),
            known.get("race_to_concept"),
            known.get("ethnicity_to_concept"),
            key_style,
        ),
        "condition_occurrence": omop.condition_occurrence(
            silver_rows["diagnoses"], known.get("icd10_to_snomed"), key_style
        ),
        "measurement": omop.union_by_name(
            omop.measurement_from_labs(
                silver_rows["labs"], known.get("loinc_to_concept"), key_style
            ),
            omop.measurement_from_variants(
                silver_rows["variants"], known.get("clinvar_to_concept"), key_style
            ),
        ),
    }


def _vocabulary(spark: SparkSession, path: str | None) -> dict[str, DataFrame]:
    """Categories of a vocabulary file as tables; the file is parsed once, into the shared folder."""
    if vocabulary_path(path) is None:
        return {}
    parsed = scratch_path(spark, "vocabulary")
    load_vocabulary(spark, path).write.parquet(parsed)
    table = spark.read.schema(ROW_LAYOUT).parquet(parsed)
    return {name: category(table, name) for name in CONCEPTS}


def key_contract(table: str) -> Contract:
    """Contract of a gold table without one of its own: its keys are never NULL."""
    rules = [
        {
            "expectation_type": "expect_column_values_to_not_be_null",
            "kwargs": {"column": c},
            "meta": {"severity": "CRITICAL_FATAL"},
        }
        for c in dict.fromkeys((*PRIMARY_KEYS[table], "person_id"))
    ]
    return contract_of({"expectation_suite_name": f"{table}_keys", "expectations": rules})


def check_gold(
    gold: Mapping[str, DataFrame], person_contract: Contract, on_fail: str = "warn"
) -> dict[str, GateResult]:
    """Gate over all rows of all gold tables; ``on_fail="fail"`` raises on a broken rule."""
    if on_fail not in ("warn", "fail"):
        raise ValueError("on_fail is 'warn' or 'fail'")
    contracts = {
        name: person_contract if name == "person" else key_contract(name) for name in gold
    }
    return {
        name: run_gate(df, contracts[name], strict=on_fail == "fail") for name, df in gold.items()
    }


def _write_silver(
    store: TableStore, name: str, parsed: DataFrame, condition: Column
) -> dict[str, int]:
    """Write accepted rows and count both sides on the way; then the rejected, if any."""
    seen = Observation(f"{name}-tiers")
    counted = parsed.observe(
        seen,
        F.count_if(silver.holds(condition)).alias("accepted"),
        F.count_if(~silver.holds(condition)).alias("quarantined"),
    )
    store.write_silver(counted.where(silver.holds(condition)), SILVER_TABLES[name])
    counts = {k: int(seen.get[k]) for k in ("accepted", "quarantined")}
    if counts["quarantined"]:
        store.write_quarantine(
            parsed.where(~silver.holds(condition)), QUARANTINE_TABLES[name]
        )
    return counts


def _staged(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """A gold table as written to the shared folder, before it is judged and loaded."""
    path = scratch_path(spark, f"gold-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def build_omop(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    output_path: str | None = None,
    load_mode: str = "overwrite",
    enforce_contracts: bool = True,
    on_fail: str = "warn",
    contract_path: str | None = None,
    vocabulary: str | None = None,
    maintain: bool = False,
    key_style: str = "masked",
) -> OmopResult:
    """Run the build. Gold is overwritten or, with ``load_mode="upsert"``, merged by key.

    An upsert rewrites the key buckets that it touches; a table that an earlier load has left
    in another layout is laid out by its keys once.
    """
    if load_mode not in ("overwrite", "upsert"):
        raise ValueError("load_mode is 'overwrite' or 'upsert'")
    parsed = parse_sources(bronze)
    mappings = _vocabulary(spark, vocabulary)
    contract = load_contract(spark, contract_path)
    if output_path is None:
        accepted = {n: silver.split_rows(df, ok).accepted for n, (df, ok) in parsed.items()}
        result = OmopResult(gold_tables(accepted, mappings, key_style))
        if enforce_contracts:
            result.gates = check_gold(result.gold, contract, on_fail)
        return result

    store = TableStore(spark, output_path)
    counts = {n: _write_silver(store, n, df, ok) for n, (df, ok) in parsed.items()}
    accepted = {n: store.read("silver", SILVER_TABLES[n]) for n in parsed}
    # Gold is worked out once: the gate, the ranges of the clustering and the load itself read what is staged here.
    gold = {n: _staged(spark, n, df) for n, df in gold_tables(accepted, mappings, key_style).items()}
    result = OmopResult({}, counts)
    if enforce_contracts:
        result.gates = check_gold(gold, contract, on_fail)
    for name, df in gold.items():
        told = {"user_metadata": f"rules_sha256={contract.sha256}"}
        if load_mode == "upsert":
            store.upsert_touched(df, name, PRIMARY_KEYS[name], relay=True, **told)
        else:
            sources = [store.current_path("silver", SILVER_TABLES[s]) for s in GOLD_SOURCES[name]]
            parts = partitions_for(store.size_of(*sources))
            store.write_gold(df, name, CLUSTER_KEYS[name], partitions=parts, **told)
        result.paths[name] = store.current_path("gold", name)
    if maintain:
        for name in gold:
            store.compact("gold", name, CLUSTER_KEYS[name])
            store.prune_versions("gold", name)
            result.paths[name] = store.current_path("gold", name)
    result.gold = {name: store.read("gold", name) for name in gold}
    return result


def gold_counts(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, persons and rows with a concept, per gold table."""
    concept = {
        "person": "gender_concept_id",
        "condition_occurrence": "condition_concept_id",
        "measurement": "measurement_concept_id",
    }
    counted = [
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("person_id").alias("persons"),
            F.count_if(F.col(concept[name]) != 0).alias("mapped_rows"),
        ).select(F.lit(name).alias("table_name"), "rows", "persons", "mapped_rows")
        for name, df in gold.items()
    ]
    return omop.union_by_name(*counted)


def main(argv: list[str] | None = None) -> OmopResult:
    parser = argparse.ArgumentParser(description="Build the OMOP gold tables")
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--export", choices=["canonical", "synthea"], default="canonical")
    parser.add_argument("--save", action=argparse.BooleanOptionalAction, default=True)
    parser.add_argument("--output-dir")
    parser.add_argument("--load-mode", choices=["overwrite", "upsert"], default="overwrite")
    parser.add_argument("--run-maintenance", action="store_true")
    parser.add_argument("--enforce-contracts", action=argparse.BooleanOptionalAction, default=True)
    parser.add_argument("--on-fail", choices=["warn", "fail"], default="warn")
    parser.add_argument("--rules-path")
    parser.add_argument("--vocabulary")
    parser.add_argument("--max-variants", type=int)
    args = parser.parse_args(argv)
    if args.save and not args.output_dir:
        parser.error("--output-dir is needed to save (or pass --no-save)")
    spark = SparkSession.builder.appName("clinlake-omop").getOrCreate()
    bronze = scan_sources(spark, args.data_dir, args.export, max_variants=args.max_variants)
    try:
        result = build_omop(
            spark,
            bronze,
            args.output_dir if args.save else None,
            args.load_mode,
            args.enforce_contracts,
            args.on_fail,
            args.rules_path,
            args.vocabulary,
            args.run_maintenance,
        )
    except ContractBreach as breach:
        raise SystemExit(str(breach)) from breach
    for source, counts in result.counts.items():
        print(f"{source}: {counts['accepted']} accepted, {counts['quarantined']} quarantined")
    for table, gate in result.gates.items():
        print(f"{table}: contract {gate.contract} {gate.success_rate:.1f} %")
    return result


if __name__ == "__main__":
    main()
