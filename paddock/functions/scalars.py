"""Column-expression helpers: calendar, JSON maps, report lines.

All are built from JVM-side functions, no Python runs.  They stay inside whole-stage codegen, but for
the sum over a map's values, whose lambda Spark interprets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

# --- fixed values: day -> (is_weekday, activity) -----------------------------
DAY_ACTIVITY = [
    ("monday", True, "guitar lessons"),
    ("tuesday", True, "studying"),
    ("wednesday", True, "soccer practice"),
    ("thursday", True, "contributing to Airflow"),
    ("friday", True, "family dinner"),
    ("saturday", False, "going to the beach"),
    ("sunday", False, "sleeping in"),
]
# --- fixed values: task groups, message and report templates ------------------
WEEKDAY_GROUP = "weekday_activities"
WEEKEND_GROUP = "weekend_activities"
ACTIVITY_MESSAGE = "It's %s and I'm busy with %s."
TOTAL_REPORT = "Total order value is: %.2f"
# Spark's dayofweek: 1 = Sunday ... 7 = Saturday.
WEEKEND_DAYS = (1, 7)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_name(ts: Column | str) -> Column:
    """Lower-case English day name, e.g. ``monday``."""
    return F.lower(F.date_format(_c(ts), "EEEE"))


def is_weekend(ts: Column | str) -> Column:
    return F.dayofweek(_c(ts)).isin(*WEEKEND_DAYS)


def weekday_route(df: DataFrame, ts: str) -> DataFrame:
    """Tag each row with its day name and the branch it takes (NULL without a time)."""
    weekend = is_weekend(ts)
    return df.select(
        "*",
        day_name(ts).alias("day_name"),
        weekend.alias("is_weekend"),
        F.when(weekend, F.lit("weekend")).when(~weekend, F.lit("weekday")).alias("route"),
    )


def day_activity_table(spark: SparkSession) -> DataFrame:
    schema = StructType([
        StructField("day_name", StringType(), False),
        StructField("is_weekday", BooleanType(), False),
        StructField("activity", StringType(), False),
    ])
    return spark.createDataFrame(DAY_ACTIVITY, schema)


def task_path(is_weekday: Column, activity: Column) -> Column:
    """``<group>.<activity with spaces as underscores>``."""
    group = F.when(is_weekday, F.lit(WEEKDAY_GROUP)).otherwise(F.lit(WEEKEND_GROUP))
    return F.concat(group, F.lit("."), F.replace(activity, F.lit(" "), F.lit("_")))


def activity_message(day: Column, activity: Column) -> Column:
    """Sentence with the capitalised day name and the activity."""
    return F.format_string(ACTIVITY_MESSAGE, F.initcap(day), activity)


def day_activity(spark: SparkSession, df: DataFrame, ts: str) -> DataFrame:
    """Look up each row's day in the seven-row activity table.

    The table has exactly seven rows (a proven size bound), so it is broadcast;
    the fact side is never shuffled.  Every timestamp has a day, so the inner
    join keeps every row with a non-NULL timestamp.
    """
    days = F.broadcast(day_activity_table(spark))
    keyed = df.select("*", day_name(ts).alias("day_name"))
    j = keyed.join(days, "day_name", "inner")
    return j.select(
        *[c for c in df.columns],
        "day_name",
        "is_weekday",
        "activity",
        task_path(F.col("is_weekday"), F.col("activity")).alias("task_path"),
        activity_message(F.col("day_name"), F.col("activity")).alias("message"),
    )


# --- JSON maps ------------------------------------------------------------------

def json_number_map(text: Column | str) -> Column:
    """Parse a JSON object of numbers into ``map<string,double>``."""
    return F.from_json(_c(text), "map<string,double>")


def map_values_sum(m: Column) -> Column:
    """Sum of a map's values (0.0 for an empty map, NULL for a NULL map); NULL values count 0."""
    return F.aggregate(F.map_values(m), F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def total_report(total: Column | str) -> Column:
    """``Total order value is: <x with two decimals>``."""
    # half-even on the exact value of the double, unlike the formatter's "%.2f"
    two = F.call_function("format_number", _c(total).cast("double"), F.lit("0.00"))
    return F.format_string(TOTAL_REPORT.replace("%.2f", "%s"), two)
