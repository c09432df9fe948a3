"""Every registered query, each with its DuckDB oracle SQL.

A query is ``(spark, sf_dir) -> DataFrame`` over the whole stand-in tables.
Importing this package registers all of them, in this order.
"""

from paddock.plans.queries import (  # noqa: F401  (imported for registration)
    telemetry,
    purchases,
    calendar_json,
    files_tables,
    runs,
    sql_forms,
)
from paddock.plans.queries.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
