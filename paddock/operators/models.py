"""Derived models: daily speed aggregates and the purchase star."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.operators.joins import dimension


@dataclass(frozen=True)
class Aggregate:
    """A model as data: what is grouped by and what is measured, as SQL expressions by output name.

    The DataFrame form (``of``) and the SQL form (``sql``) are both made from it.
    """

    keys: dict[str, str]
    measure: dict[str, str]

    def _columns(self, part: dict[str, str]) -> list[Column]:
        return [F.expr(e).alias(name) for name, e in part.items()]

    def of(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self._columns(self.keys)).agg(*self._columns(self.measure))

    def sql(self, view: str) -> str:
        columns = ", ".join(e if e == name else f"{e} AS {name}" for name, e in (self.keys | self.measure).items())
        return f"SELECT {columns} FROM {view} GROUP BY ALL"


@dataclass(frozen=True)
class Lookup:
    """``column`` is replaced by ``name`` of the dimension row whose id it holds; rows without one go."""

    column: str
    name: str


# --- telemetry aggregates ----------------------------------------------------

# ``date`` is the day of the timestamp in the session time zone (pinned to UTC by
# ``paddock.session``).
_DAY = {"team_name": "team_name", "full_name": "full_name", "location": "location", "date": "to_date(date)"}
_MEAN = {"average_speed": "avg(speed)"}
AVERAGE_SPEED = Aggregate(_DAY, _MEAN)
AVG_SPEED_GEAR = Aggregate(_DAY | {"n_gear": "n_gear"}, _MEAN)


def average_speed(enriched: DataFrame) -> DataFrame:
    """Mean speed per team, driver, location and calendar day.

    Spark plans a partial aggregate in each scan task, so a hot group costs one
    row per task in the shuffle.
    """
    return AVERAGE_SPEED.of(enriched)


def avg_speed_gear(enriched: DataFrame) -> DataFrame:
    """Mean speed per team, driver, location, day and gear."""
    return AVG_SPEED_GEAR.of(enriched)


# --- both aggregates from one pass ---------------------------------------------

DAY_KEYS = ["team_name", "full_name", "location", "date"]


def speed_partials(enriched: DataFrame) -> DataFrame:
    """Sum and count of speed per team, driver, location, day and gear.

    Both daily models follow from this one aggregate: the gear model is
    ``sum / count`` per row, the day model ``sum(sum) / sum(count)`` over the
    gears of a day.  With integer speeds the sums are exact, so both equal
    ``avg(speed)`` computed directly.
    """
    return enriched.groupBy(
        "team_name", "full_name", "location", F.to_date("date").alias("date"), "n_gear"
    ).agg(F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_count"))


def merged_partials(partials: DataFrame) -> DataFrame:
    """Sums and counts of several parts of the fact, added up."""
    return partials.groupBy(*DAY_KEYS, "n_gear").agg(
        F.sum("speed_sum").alias("speed_sum"), F.sum("speed_count").alias("speed_count")
    )


def avg_speed_gear_from_partials(partials: DataFrame) -> DataFrame:
    return partials.select(
        *DAY_KEYS, "n_gear",
        F.try_divide(F.col("speed_sum"), F.col("speed_count")).cast("double").alias("average_speed"),
    )


def average_speed_from_partials(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*DAY_KEYS).agg(
        F.try_divide(F.sum("speed_sum"), F.sum("speed_count")).cast("double").alias("average_speed")
    )


def sort_model(df: DataFrame) -> DataFrame:
    """Order a model by its key columns (all columns but the measure).

    Ordering is a read-side concern: a table write does not keep it, so it is
    applied only when a sorted result is asked for.
    """
    keys = [c for c in df.columns if c != "average_speed"]
    return df.orderBy(*keys)


# --- purchase star -------------------------------------------------------------

# The columns of the enriched purchases, in order, and those that are looked up.
PURCHASE_COLUMNS = ("id", "name", "region", "product", "qty")
PURCHASE_LOOKUPS = (Lookup("region", "name"), Lookup("product", "product"))


def orders_by(key: str) -> Aggregate:
    return Aggregate({key: key}, {"orders": "count(*)"})


def purchase_enriched(
    purchases: DataFrame,
    regions: DataFrame,
    products: DataFrame,
    broadcast: bool | None = None,
) -> DataFrame:
    """purchases(id, name, region, product, qty) joined to region and product
    names: (id, name, region <- region name, product <- product name, qty).
    Both are broadcast if they are measured small, unless ``broadcast`` is False."""
    r = regions.select(F.col("id").alias("_r_id"), F.col("name").alias("_r_name"))
    p = products.select(F.col("id").alias("_p_id"), F.col("product").alias("_p_product"))
    if broadcast is not False:
        r, p = dimension(r), dimension(p)
    return (
        purchases.join(r, purchases["region"] == r["_r_id"], "inner")
        .join(p, purchases["product"] == p["_p_id"], "inner")
        .select(
            purchases["id"],
            purchases["name"],
            r["_r_name"].alias("region"),
            p["_p_product"].alias("product"),
            purchases["qty"],
        )
    )


def count_by(enriched: DataFrame, key: str) -> DataFrame:
    """``count(*) AS orders`` per ``key`` (map-side partial counts)."""
    return orders_by(key).of(enriched)


def products_purchase_count(enriched: DataFrame) -> DataFrame:
    return count_by(enriched, "product")


def region_purchase_count(enriched: DataFrame) -> DataFrame:
    return count_by(enriched, "region")
