"""Every query of the engine by name, with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from .plans import list_queries, review_queries, rule_queries  # noqa: F401  these register their queries
from .plans.queries import ORACLE as ORACLE_SQL
from .plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
