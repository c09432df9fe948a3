"""Map the shared test tables onto the roles the ingest expects.

The test data has no telemetry files, so:

- car      <- events   (user_id -> driver_number, user_id % 25 -> session_key,
                         floor(value) -> speed, props.k % 9 -> n_gear, ts -> date)
- driver   <- customer (c_custkey as text -> driver_number, c_name -> full_name,
                         c_mktsegment -> team_name)
- session  <- nation + region (n_nationkey -> session_key, n_name -> location,
                         r_name -> country_name)
- purchases <- lineitem + orders + customer + nation
              (l_orderkey*10 + l_linenumber -> id, c_name -> name,
               n_regionkey -> region, l_partkey -> product, l_quantity -> qty)
- region / products <- region / part

Columns a role has but the stand-in lacks are typed NULLs, so every role
frame has exactly the schema of ``paddock.schemas``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.operators.joins import dimension
from paddock.schemas import CAR_COLUMNS_A, DRIVER_COLUMNS, SESSION_COLUMNS, SESSION_INT_COLUMNS, SESSION_TS_COLUMNS

SESSIONS_PER_CAR = 25  # user_id % 25 -> session_key
GEARS = 9              # props.k % 9 -> n_gear

# --- fixed values: schemas of the shared test tables ---------------------------------
# Declared, not inferred (as for every input here): no footer is read on the
# driver to plan a query, and a changed file fails loudly instead of drifting.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def car_from_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    derived = {
        "driver_number": F.col("user_id").cast("int"),
        "speed": F.floor("value").cast("int"),
        "n_gear": F.get_json_object("props", "$.k").cast("int") % F.lit(GEARS),
        "date": F.col("ts"),
        "session_key": (F.col("user_id") % F.lit(SESSIONS_PER_CAR)).cast("int"),
    }
    return events.select(
        *[(derived[c] if c in derived else F.lit(None).cast("int")).alias(c) for c in CAR_COLUMNS_A], *keep
    )


def drivers_from_customer(customer: DataFrame) -> DataFrame:
    derived = {
        "driver_number": F.col("c_custkey").cast("string"),
        "full_name": F.col("c_name"),
        "team_name": F.col("c_mktsegment"),
    }
    return customer.select(
        *[(derived[c] if c in derived else F.lit(None).cast("string")).alias(c) for c in DRIVER_COLUMNS]
    )


def sessions_from_nation(nation: DataFrame, region: DataFrame, ts_type: str = "timestamp_ntz") -> DataFrame:
    r = dimension(region.select("r_regionkey", "r_name"))
    j = nation.join(r, nation["n_regionkey"] == r["r_regionkey"], "inner")
    derived = {
        "session_key": F.col("n_nationkey").cast("int"),
        "location": F.col("n_name"),
        "country_name": F.col("r_name"),
    }

    def typed_null(c: str):
        if c in SESSION_INT_COLUMNS:
            return F.lit(None).cast("int")
        if c in SESSION_TS_COLUMNS:
            return F.lit(None).cast(ts_type)
        return F.lit(None).cast("string")

    return j.select(*[(derived[c] if c in derived else typed_null(c)).alias(c) for c in SESSION_COLUMNS])


def purchases_from_lineitem(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame
) -> DataFrame:
    """(id, name, region, product, qty).

    lineitem and orders are both fact-sized: that join is a shuffle join on the
    order key.  customer and nation go through the measured broadcast.
    """
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    o = orders.select("o_orderkey", "o_custkey")
    c = dimension(customer.select("c_custkey", "c_name", "c_nationkey"))
    n = dimension(nation.select("n_nationkey", "n_regionkey"))
    j = (
        li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
        .join(c, o["o_custkey"] == c["c_custkey"], "inner")
        .join(n, c["c_nationkey"] == n["n_nationkey"], "inner")
    )
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("c_name").alias("name"),
        F.col("n_regionkey").cast("bigint").alias("region"),
        F.col("l_partkey").alias("product"),
        F.col("l_quantity").alias("qty"),
    )


def regions_from_region(region: DataFrame) -> DataFrame:
    return region.select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"))


def products_from_part(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("product"))


def untidy(drivers: DataFrame, sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both dimensions with numbers that are missing, repeated in another spelling, no numbers at all, or NULL."""
    number, name = F.col("driver_number"), F.col("full_name")
    key = number.cast("int")
    drivers = (
        drivers.where(key % 7 != 0)
        .unionByName(drivers.where(key % 5 == 0).withColumns({"driver_number": F.concat(F.lit("0"), number), "full_name": F.concat(name, F.lit(" II"))}))
        .unionByName(drivers.where(key % 3 == 0).withColumn("driver_number", F.concat(F.lit("n"), number)))
        .unionByName(drivers.where(key % 11 == 0).withColumn("driver_number", F.lit(None).cast("string")))
    )
    session = F.col("session_key")
    sessions = sessions.where(session % 4 != 0).unionByName(
        sessions.where(session % 6 == 1).withColumn("location", F.concat("location", F.lit(" 2")))
    )
    return drivers, sessions


class StandIns:
    """Lazily built role frames for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def car(self) -> DataFrame:
        return car_from_events(self.t("events"))

    def drivers(self) -> DataFrame:
        return drivers_from_customer(self.t("customer"))

    def sessions(self) -> DataFrame:
        return sessions_from_nation(self.t("nation"), self.t("region"))

    def purchases(self) -> DataFrame:
        return purchases_from_lineitem(self.t("lineitem"), self.t("orders"), self.t("customer"), self.t("nation"))

    def regions(self) -> DataFrame:
        return regions_from_region(self.t("region"))

    def products(self) -> DataFrame:
        return products_from_part(self.t("part"))
