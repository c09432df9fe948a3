"""Registry, scenario parameters and helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.operators import models
from paddock.operators.enrich import enrich
from paddock.plans.standins import StandIns
from paddock.session import scratch_path, unique_table_name

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

# --- fixed parameters of the stand-in scenarios ---------------------------------
# The "already loaded" target of a watermark run: events before this instant.
LOADED_BEFORE = "2024-01-21 00:00:00"
# Upsert scenario: the target was built from rows before TARGET_UNTIL, the new
# source aggregate from rows at or after SOURCE_FROM (the ranges overlap).
TARGET_UNTIL = "2024-01-20 12:00:00"
SOURCE_FROM = "2024-01-15 00:00:00"
# Integer-key watermark: the earlier load holds order keys below this value.
HALF_LOADED = "o_orderkey * 2 < (SELECT MAX(o_orderkey) FROM orders)"


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def ts_ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def enriched_fact(spark: SparkSession, sf_dir: str, add_year: bool = False) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return enrich(s.car(), s.drivers(), s.sessions(), add_year=add_year)


def enriched_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = StandIns(spark, sf_dir)
    return models.purchase_enriched(s.purchases(), s.regions(), s.products())


def scratch_table(spark: SparkSession, stem: str) -> tuple[str, str]:
    return unique_table_name(f"paddock_{stem}"), scratch_path(spark, stem)


# Stand-in partitioning of the fact table (the reference's spec adds the driver
# name, which would make one folder per driver and day-year at scale).
FACT_PARTITIONS = ("year", "location")
