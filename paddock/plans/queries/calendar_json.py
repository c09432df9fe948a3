"""Column-helper queries over whole tables: JSON maps, report lines, days."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.functions import scalars
from paddock.plans.queries.base import register
from paddock.plans.queries.oracle import SQL_JSON_MAP, days_values_sql
from paddock.plans.standins import StandIns


# --- scalar helpers over whole tables ---------------------------------------------------------------


@register(
    "json_map_sum",
    f"SELECT event_id, CASE WHEN props IS NULL THEN NULL "
    f"ELSE COALESCE(list_sum(map_values({SQL_JSON_MAP})), 0.0) END AS total_order_value "
    "FROM events",
)
def q_json_map_sum(spark, sf_dir):
    e = StandIns(spark, sf_dir).t("events")
    return e.select(
        "event_id",
        scalars.map_values_sum(scalars.json_number_map("props")).alias("total_order_value"),
    )


@register(
    "json_map_total",
    f"""SELECT total_order_value, printf('{scalars.TOTAL_REPORT}', total_order_value) AS report
FROM (SELECT SUM(list_sum(map_values({SQL_JSON_MAP}))) AS total_order_value FROM events)""",
)
def q_json_map_total(spark, sf_dir):
    e = StandIns(spark, sf_dir).t("events")
    total = e.agg(
        F.sum(scalars.map_values_sum(scalars.json_number_map("props"))).alias("total_order_value")
    )
    return total.select("total_order_value", scalars.total_report("total_order_value").alias("report"))


@register(
    "report_format",
    f"SELECT o_orderkey, printf('{scalars.TOTAL_REPORT}', o_totalprice) AS report FROM orders",
)
def q_report_format(spark, sf_dir):
    o = StandIns(spark, sf_dir).t("orders")
    return o.select("o_orderkey", scalars.total_report("o_totalprice").alias("report"))


@register(
    "weekday_route",
    """SELECT event_id, ts, lower(dayname(ts)) AS day_name,
       dayofweek(ts) IN (0, 6) AS is_weekend,
       CASE WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS route
FROM events""",
)
def q_weekday_route(spark, sf_dir):
    e = StandIns(spark, sf_dir).t("events").select("event_id", "ts")
    return scalars.weekday_route(e, "ts")


@register(
    "day_names",
    "SELECT lower(dayname(ts)) AS day_name, COUNT(*) AS events FROM events GROUP BY 1",
)
def q_day_names(spark, sf_dir):
    e = StandIns(spark, sf_dir).t("events")
    return e.groupBy(scalars.day_name("ts").alias("day_name")).agg(F.count(F.lit(1)).alias("events"))


@register(
    "day_activity",
    f"""WITH {days_values_sql()}
SELECT e.event_id, e.ts, d.day_name, d.is_weekday, d.activity,
       CASE WHEN d.is_weekday THEN 'weekday_activities' ELSE 'weekend_activities' END
         || '.' || replace(d.activity, ' ', '_') AS task_path,
       'It''s ' || dayname(e.ts) || ' and I''m busy with ' || d.activity || '.' AS message
FROM events e JOIN days d ON d.day_name = lower(dayname(e.ts))""",
)
def q_day_activity(spark, sf_dir):
    e = StandIns(spark, sf_dir).t("events").select("event_id", "ts")
    return scalars.day_activity(spark, e, "ts")


