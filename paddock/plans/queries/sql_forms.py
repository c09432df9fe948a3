"""The models through Spark SQL over temp views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from paddock.operators import models
from paddock.plans import sql_models
from paddock.plans.queries.base import ORACLE_SQL, enriched_fact, register
from paddock.plans.standins import StandIns


# --- the same models through Spark SQL over temp views -----------------------------------------

def _views(spark: SparkSession, stem: str, **frames: DataFrame) -> dict[str, str]:
    tag = uuid.uuid4().hex[:8]
    names = {}
    for role, df in frames.items():
        names[role] = f"{stem}_{role}_{tag}"
        df.createOrReplaceTempView(names[role])
    return names


@register("average_speed_sql", ORACLE_SQL["average_speed"])
def q_average_speed_sql(spark, sf_dir):
    v = _views(spark, "sqlm", fact=enriched_fact(spark, sf_dir))
    return sql_models.aggregate(spark, models.AVERAGE_SPEED, v["fact"])


@register("average_speed_sorted_sql", ORACLE_SQL["average_speed_sorted"])
def q_average_speed_sorted_sql(spark, sf_dir):
    v = _views(spark, "sqlm", fact=enriched_fact(spark, sf_dir))
    return models.sort_model(sql_models.aggregate(spark, models.AVERAGE_SPEED, v["fact"]))


@register("avg_speed_gear_sql", ORACLE_SQL["avg_speed_gear"])
def q_avg_speed_gear_sql(spark, sf_dir):
    v = _views(spark, "sqlm", fact=enriched_fact(spark, sf_dir))
    return models.sort_model(sql_models.aggregate(spark, models.AVG_SPEED_GEAR, v["fact"]))


def _purchase_views(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    from paddock.operators.joins import dimension

    s = StandIns(spark, sf_dir)
    return _views(spark, "sqlp", purchases=s.purchases(),
                  region=dimension(s.regions()), product=dimension(s.products()))


@register("purchase_enriched_sql", ORACLE_SQL["purchase_enriched"])
def q_purchase_enriched_sql(spark, sf_dir):
    v = _purchase_views(spark, sf_dir)
    return sql_models.purchase_enriched(spark, v["purchases"], v)


@register("products_purchase_count_sql", ORACLE_SQL["products_purchase_count"])
def q_products_purchase_count_sql(spark, sf_dir):
    v = _purchase_views(spark, sf_dir)
    pe = _views(spark, "sqlp", enriched=sql_models.purchase_enriched(spark, v["purchases"], v))
    return sql_models.aggregate(spark, models.orders_by("product"), pe["enriched"])


@register("region_purchase_count_sql", ORACLE_SQL["region_purchase_count"])
def q_region_purchase_count_sql(spark, sf_dir):
    v = _purchase_views(spark, sf_dir)
    pe = _views(spark, "sqlp", enriched=sql_models.purchase_enriched(spark, v["purchases"], v))
    return sql_models.aggregate(spark, models.orders_by("region"), pe["enriched"])
