"""Fixed schemas.  Inputs are never inferred.

Column names and orders are fixed values that must equal the source files'
layout; they are listed here plainly.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: car telemetry column orders -----------------------------
# Layout "A": driver_number, rpm, speed, n_gear, throttle, brake, drs, date,
#             session_key, meeting_key
# Layout "B" (alphabetical): brake, date, driver_number, drs, meeting_key,
#             n_gear, rpm, session_key, speed, throttle
CAR_COLUMNS_A = [
    "driver_number", "rpm", "speed", "n_gear", "throttle",
    "brake", "drs", "date", "session_key", "meeting_key",
]
CAR_COLUMNS_B = [
    "brake", "date", "driver_number", "drs", "meeting_key",
    "n_gear", "rpm", "session_key", "speed", "throttle",
]

# --- fixed values: dimension column orders ---------------------------------
DRIVER_COLUMNS = [
    "broadcast_name", "country_code", "driver_number", "first_name",
    "full_name", "headshot_url", "last_name", "meeting_key", "name_acronym",
    "session_key", "team_colour", "team_name",
]
SESSION_COLUMNS = [
    "location", "country_key", "country_code", "country_name", "circuit_key",
    "circuit_short_name", "session_type", "session_name", "date_start",
    "date_end", "gmt_offset", "session_key", "meeting_key", "year",
]
SESSION_INT_COLUMNS = {"country_key", "session_key"}
SESSION_TS_COLUMNS = {"date_start", "date_end"}

# --- fixed values: enriched fact projection ---------------------------------
ENRICHED_DRIVER_COLUMNS = ["full_name", "team_name"]
ENRICHED_CAR_COLUMNS = ["rpm", "speed", "n_gear", "brake", "drs", "date"]
ENRICHED_SESSION_COLUMNS = ["location", "country_name"]
ENRICHED_COLUMNS = ENRICHED_DRIVER_COLUMNS + ENRICHED_CAR_COLUMNS + ENRICHED_SESSION_COLUMNS

# Unique keys of the two daily aggregates.
AVERAGE_SPEED_KEYS = ["team_name", "full_name", "location", "date"]
AVG_SPEED_GEAR_KEYS = AVERAGE_SPEED_KEYS + ["n_gear"]


def car_schema(layout: str = "A", ts_type: DataType | None = None) -> StructType:
    """Car telemetry schema; every field is an int except ``date``.

    Fields are declared nullable: a NOT NULL declaration is not enforced by
    the CSV reader anyway, and the data checks cover it.
    """
    columns = {"A": CAR_COLUMNS_A, "B": CAR_COLUMNS_B}[layout.upper()]
    ts = ts_type or TimestampType()
    return StructType(
        [StructField(c, ts if c == "date" else IntegerType(), True) for c in columns]
    )


def driver_schema() -> StructType:
    """All strings.  ``broadcast_name`` holds a name, so it is a string too."""
    return StructType([StructField(c, StringType(), True) for c in DRIVER_COLUMNS])


def session_schema(ts_type: DataType | None = None) -> StructType:
    ts = ts_type or TimestampType()
    fields = []
    for c in SESSION_COLUMNS:
        if c in SESSION_INT_COLUMNS:
            t: DataType = IntegerType()
        elif c in SESSION_TS_COLUMNS:
            t = ts
        else:
            t = StringType()
        fields.append(StructField(c, t, True))
    return StructType(fields)
