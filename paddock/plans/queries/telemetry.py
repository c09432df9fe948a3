"""Telemetry queries: star join, daily aggregates, merges, watermarks, counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paddock.operators import incremental, merge, models
from paddock.operators.enrich import enrich, join_accounts
from paddock.plans.queries.base import (
    HALF_LOADED, LOADED_BEFORE, ORACLE_SQL, SOURCE_FROM, TARGET_UNTIL,
    enriched_fact, register, ts_ntz,
)
from paddock.plans.queries.oracle import SQL_AVG, SQL_AVG_GEAR, SQL_CAR, SQL_DRV, SQL_ENRICHED, SQL_SES, merge_sql
from paddock.plans.standins import StandIns, untidy
from paddock.schemas import AVERAGE_SPEED_KEYS, AVG_SPEED_GEAR_KEYS


# --- telemetry: star join and aggregates ----------------------------------------------

@register("enrich", f"WITH {SQL_ENRICHED} SELECT * FROM enriched")
def q_enrich(spark, sf_dir):
    return enriched_fact(spark, sf_dir)


# The dimensions as `standins.untidy` makes them.
SQL_UNTIDY = f"""{SQL_CAR}, {SQL_DRV}, {SQL_SES},
drivers AS (
  SELECT * FROM drv WHERE CAST(driver_number AS INTEGER) % 7 <> 0
  UNION ALL SELECT '0' || driver_number, full_name || ' II', team_name FROM drv WHERE CAST(driver_number AS INTEGER) % 5 = 0
  UNION ALL SELECT 'n' || driver_number, full_name, team_name FROM drv WHERE CAST(driver_number AS INTEGER) % 3 = 0
  UNION ALL SELECT NULL, full_name, team_name FROM drv WHERE CAST(driver_number AS INTEGER) % 11 = 0),
sessions AS (
  SELECT * FROM ses WHERE session_key % 4 <> 0
  UNION ALL SELECT session_key, location || ' 2', country_name FROM ses WHERE session_key % 6 = 1)"""
_UNTIDY_JOIN = """
SELECT d.full_name, d.team_name, c.rpm, c.speed, c.n_gear, c.brake, c.drs, c."date", s.location, s.country_name
FROM car c {how} JOIN drivers d ON c.driver_number = TRY_CAST(d.driver_number AS INTEGER) {how} JOIN sessions s ON c.session_key = s.session_key"""


def _untidy(spark, sf_dir):
    s = StandIns(spark, sf_dir)
    return s.car(), *untidy(s.drivers(), s.sessions())


@register("enrich_untidy", f"WITH {SQL_UNTIDY} {_UNTIDY_JOIN.format(how='')}")
def q_enrich_untidy(spark, sf_dir):
    """Misses, fan-out and keys that are no numbers, on both sides of the join."""
    return enrich(*_untidy(spark, sf_dir))


@register("enrich_keep_all", f"WITH {SQL_UNTIDY} {_UNTIDY_JOIN.format(how='LEFT')}")
def q_enrich_keep_all(spark, sf_dir):
    return enrich(*_untidy(spark, sf_dir), keep_all=True)


@register(
    "enrich_accounts",
    f"""WITH {SQL_UNTIDY},
f AS (SELECT 'drivers' AS dimension, driver_number AS key, COUNT(*) AS fact_rows FROM car GROUP BY driver_number
      UNION ALL SELECT 'sessions', session_key, COUNT(*) FROM car GROUP BY session_key),
k AS (SELECT 'drivers' AS dimension, TRY_CAST(driver_number AS INTEGER) AS key FROM drivers UNION ALL SELECT 'sessions', session_key FROM sessions)
SELECT f.dimension, f.key, f.fact_rows, COUNT(k.key) AS dimension_rows, f.fact_rows * COUNT(k.key) AS joined_rows
FROM f LEFT JOIN k ON k.dimension = f.dimension AND k.key = f.key GROUP BY f.dimension, f.key, f.fact_rows""",
)
def q_enrich_accounts(spark, sf_dir):
    """Per key of both dimensions: rows that miss it, and by how much it multiplies them."""
    return join_accounts(*_untidy(spark, sf_dir))


@register(
    "enrich_with_year",
    f'WITH {SQL_ENRICHED} SELECT *, CAST(year("date") AS INTEGER) AS year FROM enriched',
)
def q_enrich_with_year(spark, sf_dir):
    return enriched_fact(spark, sf_dir, add_year=True)


@register("average_speed", f"WITH {SQL_ENRICHED} {SQL_AVG.format(src='enriched')}")
def q_average_speed(spark, sf_dir):
    return models.average_speed(enriched_fact(spark, sf_dir))


@register("avg_speed_gear", f"WITH {SQL_ENRICHED} {SQL_AVG_GEAR.format(src='enriched')}")
def q_avg_speed_gear(spark, sf_dir):
    return models.avg_speed_gear(enriched_fact(spark, sf_dir))


@register(
    "average_speed_sorted",
    f"WITH {SQL_ENRICHED} {SQL_AVG.format(src='enriched')} ORDER BY 1, 2, 3, 4",
)
def q_average_speed_sorted(spark, sf_dir):
    return models.sort_model(models.average_speed(enriched_fact(spark, sf_dir)))


@register(
    "avg_speed_gear_sorted",
    f"WITH {SQL_ENRICHED} {SQL_AVG_GEAR.format(src='enriched')} ORDER BY 1, 2, 3, 4, 5",
)
def q_avg_speed_gear_sorted(spark, sf_dir):
    return models.sort_model(models.avg_speed_gear(enriched_fact(spark, sf_dir)))


@register("merge_average_speed", merge_sql(SQL_AVG, AVERAGE_SPEED_KEYS))
def q_merge_average_speed(spark, sf_dir):
    e = enriched_fact(spark, sf_dir)
    target = models.average_speed(e.where(F.col("date") < ts_ntz(TARGET_UNTIL)))
    source = models.average_speed(e.where(F.col("date") >= ts_ntz(SOURCE_FROM)))
    return merge.upsert_rows(target, source, AVERAGE_SPEED_KEYS)


@register("merge_avg_speed_gear", merge_sql(SQL_AVG_GEAR, AVG_SPEED_GEAR_KEYS))
def q_merge_avg_speed_gear(spark, sf_dir):
    e = enriched_fact(spark, sf_dir)
    target = models.avg_speed_gear(e.where(F.col("date") < ts_ntz(TARGET_UNTIL)))
    source = models.avg_speed_gear(e.where(F.col("date") >= ts_ntz(SOURCE_FROM)))
    return merge.upsert_rows(target, source, AVG_SPEED_GEAR_KEYS)


# --- watermarks, counts, preview ---------------------------------------------------------

@register("watermark_max", "SELECT MAX(ts) AS watermark FROM events")
def q_watermark_max(spark, sf_dir):
    return incremental.high_watermark(StandIns(spark, sf_dir).t("events"), "ts")


@register(
    "incremental_filter",
    f"SELECT * FROM events WHERE ts > "
    f"(SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '{LOADED_BEFORE}')",
)
def q_incremental_filter(spark, sf_dir):
    events = StandIns(spark, sf_dir).t("events")
    target = events.where(F.col("ts") < ts_ntz(LOADED_BEFORE))
    return incremental.newer_than(events, target, "ts")


@register("incremental_filter_sql", ORACLE_SQL["incremental_filter"])
def q_incremental_filter_sql(spark, sf_dir):
    tag = uuid.uuid4().hex[:8]
    events = StandIns(spark, sf_dir).t("events")
    src, tgt = f"events_src_{tag}", f"events_loaded_{tag}"
    events.createOrReplaceTempView(src)
    events.where(F.col("ts") < ts_ntz(LOADED_BEFORE)).createOrReplaceTempView(tgt)
    return incremental.newer_than_sql(spark, src, tgt, "ts")


@register(
    "incremental_filter_id",
    f"SELECT * FROM orders WHERE o_orderkey > "
    f"(SELECT MAX(o_orderkey) FROM orders WHERE {HALF_LOADED})",
)
def q_incremental_filter_id(spark, sf_dir):
    orders = StandIns(spark, sf_dir).t("orders")
    # The lower half of the key range counts as loaded, at any size of the table.
    target = orders.where(F.col("o_orderkey") * 2 < orders.agg(F.max("o_orderkey")).scalar())
    return incremental.newer_than(orders, target, "o_orderkey")


@register("row_count", "SELECT COUNT(*) AS row_count FROM events")
def q_row_count(spark, sf_dir):
    return StandIns(spark, sf_dir).t("events").agg(F.count(F.lit(1)).alias("row_count"))


@register("preview_limit", "SELECT * FROM events ORDER BY ts, event_id LIMIT 5")
def q_preview_limit(spark, sf_dir):
    # The limit is the feature (a five-row preview); the order makes it stable.
    return StandIns(spark, sf_dir).t("events").orderBy("ts", "event_id").limit(5)


