"""Registered queries (Spark) and their DuckDB oracle SQL."""

from .registry import QUERIES
from .oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]
