"""Queries over the given tables, each with its SQL counterpart where one exists."""

from workload import q_audit, q_columns, q_omop, q_quality, q_sources, q_tables  # noqa: F401
from workload.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
