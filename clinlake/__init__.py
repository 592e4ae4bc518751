"""PySpark toolkit for governed clinical and genomic lakehouse tables."""

from clinlake.operators.audits import all_checks
from clinlake.operators.commits import commit_rollup, commit_tail, table_rollup, tail_summary
from clinlake.operators.concept_tools import (
    lookup_clinvar,
    lookup_demographic,
    lookup_icd10,
    lookup_loinc,
)
from clinlake.operators.contracts import (
    rule_results,
    run_gate,
    summarise,
    violations,
    with_violations,
)
from clinlake.operators.ledger import experiment_state, latest_run, run_evidence, run_state
from clinlake.operators.merge import dedup_keys, snapshot_diff, upsert
from clinlake.operators.omop import (
    condition_occurrence,
    measurement,
    measurement_from_labs,
    measurement_from_variants,
    person,
)
from clinlake.operators.registry import conformance, registry
from clinlake.sinks.tables import TableStore
from clinlake.sources.contracts import load_contract, scan_contracts
from clinlake.sources.vocabulary import load_vocabulary, query_vocabulary

__all__ = [
    "TableStore",
    "all_checks",
    "commit_rollup",
    "commit_tail",
    "condition_occurrence",
    "conformance",
    "dedup_keys",
    "experiment_state",
    "latest_run",
    "load_contract",
    "load_vocabulary",
    "lookup_clinvar",
    "lookup_demographic",
    "lookup_icd10",
    "lookup_loinc",
    "measurement",
    "measurement_from_labs",
    "measurement_from_variants",
    "person",
    "query_vocabulary",
    "registry",
    "rule_results",
    "run_evidence",
    "run_gate",
    "run_state",
    "scan_contracts",
    "snapshot_diff",
    "summarise",
    "table_rollup",
    "tail_summary",
    "upsert",
    "violations",
    "with_violations",
]
