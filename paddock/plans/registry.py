"""Registered queries and their DuckDB oracle SQL (see ``paddock.plans.queries``)."""

from paddock.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
