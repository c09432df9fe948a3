"""Star join of car telemetry with the driver and session dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.operators.joins import dimension
from paddock.schemas import (
    ENRICHED_CAR_COLUMNS,
    ENRICHED_DRIVER_COLUMNS,
    ENRICHED_SESSION_COLUMNS,
)


def _maybe_dimension(df: DataFrame, broadcast: bool | None) -> DataFrame:
    return df if broadcast is False else dimension(df)


def enrich(
    car: DataFrame,
    drivers: DataFrame,
    sessions: DataFrame,
    *,
    driver_keys: Sequence[str] = ("driver_number",),
    add_year: bool = False,
    broadcast: bool | None = None,
    keep_all: bool = False,
) -> DataFrame:
    """Join car rows to drivers and sessions and project the fact.

    A row that finds no driver or no session is left out; with ``keep_all`` it stays, NULL in
    their columns.  ``join_accounts`` tells how many of each there are.

    Output columns: full_name, team_name, rpm, speed, n_gear, brake, drs, date,
    location, country_name (+ year when ``add_year``).

    - The driver file keys are text; they are matched with ``try_cast(.. as
      int)`` so a non-numeric key simply finds no partner instead of failing
      the job under ANSI mode.
    - By default drivers are matched on ``driver_number`` only: a number that
      appears n times in the driver file yields n output rows per car row.
      Pass ``driver_keys=("driver_number", "session_key")`` to key on both.
    - Only the needed dimension columns are kept before the join, and a
      dimension is broadcast only after it is measured small, and never with
      ``broadcast=False``; otherwise the join is a shuffle join keyed on the same columns.
    """
    drv_cols = [
        F.col(k).try_cast("int").alias(f"_drv_{k}") for k in driver_keys
    ] + [F.col(c) for c in ENRICHED_DRIVER_COLUMNS]
    drv = drivers.select(*drv_cols)
    ses = sessions.select(
        F.col("session_key").alias("_ses_session_key"),
        *[F.col(c) for c in ENRICHED_SESSION_COLUMNS],
    )
    fact = car.select(
        *dict.fromkeys(list(driver_keys) + ["session_key"] + ENRICHED_CAR_COLUMNS)
    )

    drv = _maybe_dimension(drv, broadcast)
    ses = _maybe_dimension(ses, broadcast)

    drv_cond = [fact[k] == drv[f"_drv_{k}"] for k in driver_keys]
    how = "left" if keep_all else "inner"
    joined = fact.join(drv, drv_cond, how).join(ses, fact["session_key"] == ses["_ses_session_key"], how)
    out = joined.select(
        *[drv[c] for c in ENRICHED_DRIVER_COLUMNS],
        *[fact[c] for c in ENRICHED_CAR_COLUMNS],
        *[ses[c] for c in ENRICHED_SESSION_COLUMNS],
    )
    return with_year(out) if add_year else out


def join_accounts(car: DataFrame, drivers: DataFrame, sessions: DataFrame) -> DataFrame:
    """What the star join makes of each key: ``dimension, key, fact_rows, dimension_rows, joined_rows``.

    ``joined_rows`` is 0 for a key that is missed (NULL included) and a multiple of ``fact_rows`` for a
    number that the dimension repeats; each dimension is looked at by itself.  The fact is
    read once: its rows are counted by both keys at a time, partially in every task, so that a key
    with a third of all rows is one row in the join.
    """
    counted = car.groupingSets([[F.col("driver_number")], [F.col("session_key")]], "driver_number", "session_key").agg(
        F.count(F.lit(1)).alias("fact_rows"), (F.grouping("driver_number") == 0).alias("by_driver")
    )
    fact = counted.select(
        F.when(F.col("by_driver"), "drivers").otherwise("sessions").alias("dimension"),
        F.when(F.col("by_driver"), F.col("driver_number")).otherwise(F.col("session_key")).alias("key"), "fact_rows",
    )
    keys = drivers.select(F.lit("drivers").alias("dimension"), F.col("driver_number").try_cast("int").alias("key")).unionAll(
        sessions.select(F.lit("sessions").alias("dimension"), F.col("session_key").cast("int").alias("key"))
    )
    held = keys.where(F.col("key").isNotNull()).groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("dimension_rows"))
    rows = F.coalesce(F.col("dimension_rows"), F.lit(0))
    return fact.join(held, ["dimension", "key"], "left").select(
        "dimension", "key", "fact_rows", rows.alias("dimension_rows"), (F.col("fact_rows") * rows).alias("joined_rows")
    )


def with_year(df: DataFrame, ts_column: str = "date") -> DataFrame:
    """Add the ``year`` partition column derived from the timestamp."""
    return df.withColumn("year", F.year(ts_column))
