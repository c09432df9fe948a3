"""DuckDB oracle SQL: the stand-in roles built from the raw views.

Every registered query's oracle is assembled from these blocks, so the
stand-in mapping is stated once for DuckDB (and once, in
``paddock.plans.standins``, for Spark).
"""

from __future__ import annotations

from paddock.functions import scalars
from paddock.plans.queries.base import LOADED_BEFORE, SOURCE_FROM, TARGET_UNTIL

SQL_CAR = """
car AS (
  SELECT CAST(user_id AS INTEGER) AS driver_number,
         CAST(NULL AS INTEGER) AS rpm,
         CAST(FLOOR(value) AS INTEGER) AS speed,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 9 AS n_gear,
         CAST(NULL AS INTEGER) AS throttle,
         CAST(NULL AS INTEGER) AS brake,
         CAST(NULL AS INTEGER) AS drs,
         ts AS "date",
         CAST(user_id % 25 AS INTEGER) AS session_key,
         CAST(NULL AS INTEGER) AS meeting_key
  FROM events)"""
SQL_DRV = """
drv AS (
  SELECT CAST(c_custkey AS VARCHAR) AS driver_number, c_name AS full_name,
         c_mktsegment AS team_name
  FROM customer)"""
SQL_SES = """
ses AS (
  SELECT n_nationkey AS session_key, n_name AS location, r_name AS country_name
  FROM nation JOIN region ON r_regionkey = n_regionkey)"""
SQL_ENRICHED = f"""
{SQL_CAR},
{SQL_DRV},
{SQL_SES},
enriched AS (
  SELECT d.full_name, d.team_name, c.rpm, c.speed, c.n_gear, c.brake, c.drs,
         c."date", s.location, s.country_name
  FROM car c
  JOIN drv d ON c.driver_number = TRY_CAST(d.driver_number AS INTEGER)
  JOIN ses s ON c.session_key = s.session_key)"""
SQL_AVG = """
SELECT team_name, full_name, location, CAST("date" AS DATE) AS "date",
       AVG(speed) AS average_speed
FROM {src} GROUP BY team_name, full_name, location, CAST("date" AS DATE)"""
SQL_AVG_GEAR = """
SELECT team_name, full_name, location, CAST("date" AS DATE) AS "date", n_gear,
       AVG(speed) AS average_speed
FROM {src} GROUP BY team_name, full_name, location, CAST("date" AS DATE), n_gear"""
SQL_CP = """
cp AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, c_name AS name,
         CAST(n_regionkey AS BIGINT) AS region, l_partkey AS product,
         l_quantity AS qty
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey)"""
SQL_PE = f"""
{SQL_CP},
regions AS (SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region),
products AS (SELECT p_partkey AS id, p_name AS product FROM part),
pe AS (
  SELECT c.id, c.name, r.name AS region, p.product, c.qty
  FROM cp c JOIN regions r ON r.id = c.region JOIN products p ON p.id = c.product)"""


def merge_sql(agg_sql: str, keys: list[str]) -> str:
    on = " AND ".join(f'u."{k}" = t."{k}"' for k in keys)
    return f"""
WITH {SQL_ENRICHED},
t AS ({agg_sql.format(src=f"(SELECT * FROM enriched WHERE \"date\" < TIMESTAMP '{TARGET_UNTIL}')")}),
u AS ({agg_sql.format(src=f"(SELECT * FROM enriched WHERE \"date\" >= TIMESTAMP '{SOURCE_FROM}')")})
SELECT * FROM u
UNION ALL
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE {on})"""


def check_sql(test_name: str, failing_sql: str) -> str:
    return f"""
SELECT '{test_name}' AS test_name, COUNT(*) AS failures,
       CASE WHEN COUNT(*) = 0 THEN 'pass' ELSE 'fail' END AS status
FROM ({failing_sql}) f"""


def days_values_sql() -> str:
    rows = ", ".join(
        "('{}', {}, '{}')".format(d, "TRUE" if wk else "FALSE", a.replace("'", "''"))
        for d, wk, a in scalars.DAY_ACTIVITY
    )
    return f"days(day_name, is_weekday, activity) AS (VALUES {rows})"


SQL_JSON_MAP = "CAST(CAST(props AS JSON) AS MAP(VARCHAR, DOUBLE))"

SQL_ENRICHED_YEAR = f'WITH {SQL_ENRICHED} SELECT *, CAST(year("date") AS INTEGER) AS year FROM enriched'


def null_cols_sql(columns: list[str], present: dict[str, str], types: dict[str, str], default: str) -> str:
    return ", ".join(
        f'{present[c]} AS "{c}"' if c in present else f'CAST(NULL AS {types.get(c, default)}) AS "{c}"'
        for c in columns
    )


SQL_INGEST_REPORT = f"""
WITH {SQL_ENRICHED},
r1 AS (
  SELECT (SELECT COUNT(*) FROM car WHERE "date" < TIMESTAMP '{LOADED_BEFORE}') AS new_fact_rows,
         (SELECT COUNT(*) FROM enriched WHERE "date" < TIMESTAMP '{LOADED_BEFORE}') AS rows_written,
         (SELECT MAX("date") FROM enriched WHERE "date" < TIMESTAMP '{LOADED_BEFORE}') AS wm),
r2 AS (
  SELECT (SELECT COUNT(*) FROM car WHERE "date" > (SELECT wm FROM r1)) AS new_fact_rows,
         (SELECT COUNT(*) FROM enriched WHERE "date" > (SELECT wm FROM r1)) AS rows_written,
         (SELECT MAX("date") FROM enriched) AS wm)
SELECT 1 AS run, TRUE AS created, CAST(NULL AS TIMESTAMP) AS watermark_before,
       new_fact_rows, rows_written, rows_written AS table_rows, wm AS watermark_after
FROM r1
UNION ALL
SELECT 2, FALSE, (SELECT wm FROM r1), new_fact_rows, rows_written,
       (SELECT rows_written FROM r1) + rows_written, wm
FROM r2"""
