"""File-stream variant of the ingest (optional; not a replacement).

Structured Streaming tracks *files already processed* in its checkpoint, not a
max(date) watermark: every new file is loaded, including late rows that the
batch run's strict watermark skips.  Each run with ``availableNow`` processes
all files that arrived since the last run and stops; a restart after a lost
executor or driver resumes from the checkpoint without duplicates (the file
sink commits each micro-batch atomically through its own log).

The dimensions are static frames; a stream-static inner join keeps no state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructType

from paddock.operators.enrich import enrich
from paddock.schemas import car_schema


def car_stream(
    spark: SparkSession,
    car_dir: str,
    layout: str = "A",
    ts_type: DataType | None = None,
    max_files_per_trigger: int | None = None,
    **csv_options: str,
) -> DataFrame:
    reader = (
        spark.readStream.schema(car_schema(layout, ts_type))
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", "true")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in csv_options.items():
        reader = reader.option(k, v)
    return reader.csv(car_dir)


def start_file_ingest(
    spark: SparkSession,
    car: DataFrame,
    drivers: DataFrame,
    sessions: DataFrame,
    out_path: str,
    checkpoint: str,
    *,
    partition_cols: Sequence[str] = ("year", "location"),
    available_now: bool = True,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the enrich-and-append stream into a partitioned Parquet folder."""
    enriched = enrich(car, drivers, sessions, add_year=True)
    w = (
        enriched.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_output(spark: SparkSession, out_path: str, schema: StructType) -> DataFrame:
    """Read what the stream committed, with the declared column types.

    The file sink's log lists only committed files (no partial batches), and a
    given schema stops partition values such as a numeric-looking location
    from being re-typed by inference.
    """
    return spark.read.schema(schema).parquet(out_path)


def run_file_ingest_once(
    spark: SparkSession,
    car: DataFrame,
    drivers: DataFrame,
    sessions: DataFrame,
    out_path: str,
    checkpoint: str,
    *,
    partition_cols: Sequence[str] = ("year", "location"),
    timeout_s: float | None = None,
) -> StreamingQuery:
    """Process every file not yet seen, then stop.

    With ``timeout_s`` a run that has not finished in time is stopped and
    reported; the checkpoint keeps what was committed, so the next run resumes.
    """
    q = start_file_ingest(
        spark, car, drivers, sessions, out_path, checkpoint, partition_cols=partition_cols
    )
    finished = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if finished is False:
        q.stop()
        raise TimeoutError(f"file ingest did not finish within {timeout_s} s")
    return q


def enriched_schema(car: DataFrame, drivers: DataFrame, sessions: DataFrame) -> StructType:
    """Schema of the stream's output rows (no job runs)."""
    return enrich(car, drivers, sessions, add_year=True, broadcast=False).schema
