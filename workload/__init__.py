"""Registered queries: every operator over the given tables, with SQL to compare against."""

from workload import ingest, landing, models, observe, quality  # noqa: F401
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
