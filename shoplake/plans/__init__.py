"""Registered queries, their DuckDB oracle SQL and job definitions."""

from shoplake.plans.oracle import ORACLE_SQL
from shoplake.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
