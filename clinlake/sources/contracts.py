"""Data contracts: JSON documents with a list of rules."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.fixed_values import DEFAULT_CONTRACT, DEFAULT_SEVERITY
from clinlake.functions.parsing import as_column
from clinlake.workspace import path_exists

DOCUMENT_LAYOUT = (
    "data_asset_type string, expectation_suite_name string, meta map<string,string>, "
    "expectations array<struct<expectation_type:string,kwargs:map<string,string>,"
    "meta:struct<severity:string>>>"
)


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str | None
    options: Mapping[str, Any]
    severity: str


@dataclass(frozen=True)
class Contract:
    name: str
    rules: tuple[Rule, ...]
    meta: Mapping[str, str] = field(default_factory=dict)
    sha256: str = ""
    path: str | None = None


def contract_of(document: Mapping[str, Any], sha256: str = "", path: str | None = None) -> Contract:
    """Contract of a parsed document. Rules without a severity count as errors."""
    rules = []
    for entry in document.get("expectations", []):
        options = dict(entry.get("kwargs") or {})
        severity = (entry.get("meta") or {}).get("severity") or DEFAULT_SEVERITY
        rules.append(
            Rule(entry.get("expectation_type", ""), options.pop("column", None), options, severity)
        )
    name = document.get("expectation_suite_name") or "unnamed"
    return Contract(name, tuple(rules), document.get("meta") or {}, sha256, path)


def load_contract(spark: SparkSession, path: str | None = None) -> Contract:
    """One contract file from any path Spark can read; without a path the built-in one."""
    if path is None:
        text = json.dumps(DEFAULT_CONTRACT, sort_keys=True)
    elif path_exists(spark, path):
        text = spark.read.text(path, wholetext=True).first()["value"]
    else:
        raise FileNotFoundError(f"no such contract: {path}")
    digest = hashlib.sha256(text.encode("utf-8")).hexdigest()
    return contract_of(json.loads(text), digest, path)


def rules_of(documents: DataFrame, document: Column | str = "value") -> DataFrame:
    """One row per rule of any number of contract documents, with the digest of its document."""
    parsed = documents.select(
        F.sha2(as_column(document), 256).alias("rules_sha256"),
        F.from_json(as_column(document), DOCUMENT_LAYOUT).alias("doc"),
    )
    exploded = parsed.select(
        "rules_sha256",
        F.col("doc.data_asset_type").alias("data_asset_type"),
        F.col("doc.expectation_suite_name").alias("suite_name"),
        F.col("doc.meta").alias("meta"),
        F.size("doc.expectations").alias("expectations_count"),
        F.posexplode("doc.expectations").alias("position", "rule"),
    )
    return exploded.select(
        "suite_name",
        "data_asset_type",
        "rules_sha256",
        "meta",
        "expectations_count",
        "position",
        F.col("rule.expectation_type").alias("expectation_type"),
        F.col("rule.kwargs")["column"].alias("column_name"),
        F.map_filter("rule.kwargs", lambda k, _: k != "column").alias("options"),
        F.coalesce("rule.meta.severity", F.lit(DEFAULT_SEVERITY)).alias("severity"),
    )


def scan_contracts(spark: SparkSession, path: str) -> DataFrame:
    """Rules of all contract files under a path."""
    return rules_of(spark.read.text(path, wholetext=True))
