"""Source and sink queries: CSV export and read-back, tables written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from paddock.operators import incremental, models
from paddock.plans import sinks
from paddock.plans.queries.base import (
    FACT_PARTITIONS, LOADED_BEFORE, ORACLE_SQL, SOURCE_FROM, TARGET_UNTIL,
    enriched_fact, enriched_purchases, register, scratch_table, ts_ntz,
)
from paddock.plans.queries.oracle import SQL_CAR, SQL_ENRICHED_YEAR, SQL_PE, null_cols_sql
from paddock.plans.standins import StandIns
from paddock.schemas import (
    AVERAGE_SPEED_KEYS, AVG_SPEED_GEAR_KEYS, CAR_COLUMNS_A, CAR_COLUMNS_B, DRIVER_COLUMNS, SESSION_COLUMNS,
)
from paddock.session import scratch_path
from paddock.sources import files


# --- sources: CSV export and read-back -----------------------------------------------------------

@register("scan_csv_recursive", f"WITH {SQL_CAR} SELECT * FROM car")
def q_scan_csv_recursive(spark, sf_dir):
    car = StandIns(spark, sf_dir).car().withColumn("day", F.date_format("date", "yyyy-MM-dd"))
    path = scratch_path(spark, "car_csv_tree")
    files.write_csv(car, path, columns=CAR_COLUMNS_A, nest_by="day")
    return files.read_car_csv(
        spark, path, "A", recursive=True, ts_type=TimestampNTZType(),
        timestamp_ntz_format=files.TS_NTZ_FORMAT,
    )


@register(
    "scan_csv_glob",
    f"WITH {SQL_CAR} SELECT " + ", ".join(f'"{c}"' for c in CAR_COLUMNS_B) + " FROM car",
)
def q_scan_csv_glob(spark, sf_dir):
    car = StandIns(spark, sf_dir).car()
    path = scratch_path(spark, "car_csv_flat")
    files.write_csv(car, path, columns=CAR_COLUMNS_B)
    return files.read_car_csv(
        spark, f"{path}/*.csv", "B", recursive=False, ts_type=TimestampNTZType(),
        timestamp_ntz_format=files.TS_NTZ_FORMAT,
    )


@register(
    "scan_dim_drivers",
    "SELECT "
    + null_cols_sql(
        DRIVER_COLUMNS,
        {"driver_number": "CAST(c_custkey AS VARCHAR)", "full_name": "c_name", "team_name": "c_mktsegment"},
        {},
        "VARCHAR",
    )
    + " FROM customer",
)
def q_scan_dim_drivers(spark, sf_dir):
    path = scratch_path(spark, "drivers_csv")
    files.write_csv(StandIns(spark, sf_dir).drivers(), path)
    return files.read_drivers(spark, path)


@register(
    "scan_dim_sessions",
    "SELECT "
    + null_cols_sql(
        SESSION_COLUMNS,
        {"session_key": "n_nationkey", "location": "n_name", "country_name": "r_name"},
        {"country_key": "INTEGER", "date_start": "TIMESTAMP", "date_end": "TIMESTAMP"},
        "VARCHAR",
    )
    + " FROM nation JOIN region ON r_regionkey = n_regionkey",
)
def q_scan_dim_sessions(spark, sf_dir):
    path = scratch_path(spark, "sessions_csv")
    files.write_csv(StandIns(spark, sf_dir).sessions(), path)
    return files.read_sessions(
        spark, path, ts_type=TimestampNTZType(), timestamp_ntz_format=files.TS_NTZ_FORMAT
    )


# --- sinks: tables written under the scratch root and read back ---------------------------------


@register("table_roundtrip", SQL_ENRICHED_YEAR)
def q_table_roundtrip(spark, sf_dir):
    name, path = scratch_table(spark, "fact_roundtrip")
    sinks.create_table(enriched_fact(spark, sf_dir, add_year=True), name, FACT_PARTITIONS, path=path)
    return spark.table(name)


@register("incremental_append", SQL_ENRICHED_YEAR)
def q_incremental_append(spark, sf_dir):
    name, path = scratch_table(spark, "fact_append")
    enriched = enriched_fact(spark, sf_dir, add_year=True)
    # Day one: everything loaded before the cut-off creates the table.
    sinks.create_or_append(
        enriched.where(F.col("date") < ts_ntz(LOADED_BEFORE)), name, FACT_PARTITIONS, path=path
    )
    # Day two: only rows strictly newer than the table's watermark are appended.
    wm = spark.table(name).agg(F.max("date").alias("wm")).first()["wm"]
    sinks.create_or_append(incremental.newer_than_value(enriched, "date", wm), name)
    return spark.table(name)


@register(
    "table_refresh",
    f"WITH {SQL_PE} SELECT product, COUNT(*) AS orders FROM pe GROUP BY product",
)
def q_table_refresh(spark, sf_dir):
    name, path = scratch_table(spark, "products_count")
    pe = enriched_purchases(spark, sf_dir)
    # A stale first build, then a full refresh replaces every row.
    sinks.create_table(models.products_purchase_count(pe.where(F.col("qty") < 10)), name, path=path)
    sinks.refresh(models.products_purchase_count(pe), name)
    return spark.table(name)


@register("upsert_average_speed", ORACLE_SQL["merge_average_speed"])
def q_upsert_average_speed(spark, sf_dir):
    return _upsert_scenario(spark, sf_dir, models.average_speed, AVERAGE_SPEED_KEYS, "avg_speed")


@register("upsert_avg_speed_gear", ORACLE_SQL["merge_avg_speed_gear"])
def q_upsert_avg_speed_gear(spark, sf_dir):
    return _upsert_scenario(spark, sf_dir, models.avg_speed_gear, AVG_SPEED_GEAR_KEYS, "avg_speed_gear")


def _upsert_scenario(spark, sf_dir, model, keys, stem):
    name, path = scratch_table(spark, stem)
    e = enriched_fact(spark, sf_dir)
    sinks.upsert(model(e.where(F.col("date") < ts_ntz(TARGET_UNTIL))), name, keys, path=path)
    sinks.upsert(model(e.where(F.col("date") >= ts_ntz(SOURCE_FROM))), name, keys)
    return spark.table(name)


# Schema sync scenario: orders placed before this instant were loaded with the
# old columns; later orders arrive with the new ones.
SCHEMA_CHANGED_AT = "1999-01-01 00:00:00"


@register(
    "schema_sync",
    f"""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '{SCHEMA_CHANGED_AT}' THEN o_orderpriority END AS o_orderpriority
FROM orders""",
)
def q_schema_sync(spark, sf_dir):
    name, path = scratch_table(spark, "orders_sync")
    orders = StandIns(spark, sf_dir).t("orders")
    old = orders.where(F.col("o_orderdate") < ts_ntz(SCHEMA_CHANGED_AT))
    sinks.create_table(
        old.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), name, path=path
    )
    new = orders.where(F.col("o_orderdate") >= ts_ntz(SCHEMA_CHANGED_AT)).select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        "o_orderpriority",
    )
    # Added: o_orderpriority; dropped: o_totalprice; retyped: o_custkey.
    sinks.sync_all_columns(spark, name, new.schema)
    sinks.append(new, name)
    return spark.table(name)


@register(
    "schema_drop",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '{SCHEMA_CHANGED_AT}' THEN o_orderpriority END AS o_orderpriority, o_orderstatus
FROM orders""",
)
def q_schema_drop(spark, sf_dir):
    """A column goes and another comes without a data file being written; the table is partitioned."""
    name, path = scratch_table(spark, "orders_drop")
    orders = StandIns(spark, sf_dir).t("orders")
    old = orders.where(F.col("o_orderdate") < ts_ntz(SCHEMA_CHANGED_AT))
    sinks.create_table(old.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), name, ["o_orderstatus"], path=path)
    new = orders.where(F.col("o_orderdate") >= ts_ntz(SCHEMA_CHANGED_AT)).select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    before = sorted(spark.table(name).inputFiles())
    sinks.sync_all_columns(spark, name, new.schema)
    assert sorted(spark.table(name).inputFiles()) == before
    sinks.append(new, name)
    return spark.table(name)


