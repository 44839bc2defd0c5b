"""Named queries over the driver tables, each with its DuckDB oracle SQL."""

from tabkiln.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
