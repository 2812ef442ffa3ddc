"""All registered queries."""

from __future__ import annotations

from millrace.plans import (
    queries_aggregates,
    queries_changes,
    queries_jobs,
    queries_joins,
    queries_rows,
    queries_scalars,
    queries_sources,
    queries_streaming,
    queries_subqueries,
    queries_windows,
)
from millrace.plans.registry import QUERIES

__all__ = [
    "QUERIES", "queries_aggregates", "queries_changes", "queries_jobs", "queries_joins", "queries_rows",
    "queries_scalars", "queries_sources", "queries_streaming", "queries_subqueries", "queries_windows",
]
