"""paddock: incremental telemetry tables on Spark DataFrames.

Layout
------
- ``schemas``    fixed input/output schemas (car layouts A and B, driver,
                 session, enriched fact, model keys)
- ``session``    session defaults (local and cluster profiles), shared
                 checkpoint / scratch folders
- ``sources``    CSV readers with declared schemas, catalog tables, JDBC
- ``operators``  DataFrame -> DataFrame building blocks: measured broadcast
                 joins, watermark filters, the star join, daily aggregates,
                 MERGE-style upsert rows, purchase star, data tests
- ``functions``  column-expression helpers (calendar, JSON maps, reports)
- ``plans``      table sinks, the ingest run and daily job (plus its submit
                 entry), SQL forms of the models, the test-table stand-ins and
                 the registered queries with their oracle SQL
- ``streaming``  an optional file-stream variant of the ingest

Every public function builds a lazy plan; only sinks, runs and size checks
trigger Spark jobs.  Nothing runs at import time.
"""

__all__ = ["functions", "operators", "plans", "schemas", "session", "sources", "streaming"]
