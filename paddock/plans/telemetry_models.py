"""The telemetry models, built from the ingest job's output table.

1. the fact copy: an incremental append of the source rows strictly newer
   than the copy's watermark (created with all rows the first time, or when
   the copy is empty), partitioned by team and driver;
2. the two daily aggregates, kept up with the copy's files (``speed_state``): by
   default only the appended files are read for them; ``full_refresh_models=True``
   recomputes every day, as the SQL models do.

How many rows were copied is observed while they are written; the copy is read once a run,
for its watermark.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from paddock.plans import sinks
from paddock.plans.ingest import observed, refresh_stale_models, token_literal, watermark_token

# --- fixed values: model names and the copy's partitioning ---------------------------
FACT_COPY = "car_telemetry_copy"
AVERAGE_SPEED = "average_speed"
AVG_SPEED_GEAR = "avg_speed_gear"
COPY_PARTITIONS = ("team_name", "full_name")


@dataclass
class TelemetryModelNames:
    prefix: str = ""
    path_root: str | None = None

    def table(self, name: str) -> str:
        return self.prefix + name

    def path(self, name: str) -> str | None:
        return f"{self.path_root.rstrip('/')}/{name}" if self.path_root else None


def build_telemetry_models(
    spark: SparkSession,
    source_table: str,
    names: TelemetryModelNames | None = None,
    *,
    copy_partitions: Sequence[str] = COPY_PARTITIONS,
    full_refresh_models: bool = False,
    on_schema_change: str = "sync_all_columns",
) -> int:
    """Run the chain once; returns the number of rows appended to the copy."""
    n = names or TelemetryModelNames()
    copy = n.table(FACT_COPY)
    source = spark.table(source_table)
    date_type = source.schema["date"].dataType
    sinks.attach_if_present(spark, copy, n.path(FACT_COPY))
    token = None
    written = Observation("copied")
    count = F.count(F.lit(1)).alias("n")
    if sinks.table_exists(spark, copy):
        token, _ = watermark_token(spark.table(copy), "date")
        new = source if token is None else source.where(F.col("date") > token_literal(token, date_type))
        if on_schema_change == "sync_all_columns":
            sinks.sync_all_columns(spark, copy, source.schema)
        if not new.isEmpty():
            sinks.append(new.observe(written, count), copy, ignore_extra=on_schema_change == "ignore")
            appended = written.get["n"]
        else:
            appended = 0
    else:
        sinks.create_table(source.observe(written, count), copy, copy_partitions, path=n.path(FACT_COPY))
        appended = (observed(written) or {"n": 0})["n"]
    if appended and not sinks.is_file_table(spark, copy):
        token, _ = watermark_token(spark.table(copy), "date")

    refresh_stale_models(
        spark, copy, n.table(AVERAGE_SPEED), n.table(AVG_SPEED_GEAR), token, incremental=not full_refresh_models,
        path_average_speed=n.path(AVERAGE_SPEED), path_avg_speed_gear=n.path(AVG_SPEED_GEAR),
    )
    return appended

