"""Helpers shared by the operators: safe column access, staging, work tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paddock.session import scratch_path

#: Rows turned into Python objects at a time; bounds a worker's memory.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """The frame with columns c0, c1, ..: no other name of a caller can clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``new=old`` columns alone; ``old`` is matched exactly, case included."""
    at = {new: df.columns.index(old) for new, old in columns.items()}
    return numbered(df).select(*[F.col(f"c{i}").alias(new) for new, i in at.items()])


#: Spark then removes a query's shuffle files when the query is over, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors.

    The shuffle files of the write go once it has committed; the frame itself must not be run again.
    """
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """The rows that no model learns from: crc32 of the id's text, modulo 3, is 1 (a null id: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def slices(batch: pa.RecordBatch, rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


# -- tables of a fixed size, added up over all tasks ------------------------

#: Entries of a work table that travel as one row.
CHUNK = 8192
SUM_SCHEMA = "part int, body binary"


def table_rows(values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """One task's table as rows (part, body); parts with zeros alone are left out."""
    for k in range(0, len(values), CHUNK):
        if (part := values[k : k + CHUNK]).any():
            yield k // CHUNK, part.tobytes()


def add_tables(rows: DataFrame, size: int, dtype: str) -> np.ndarray:
    """Sum of the tasks' tables: added part by part on executors, ``size`` numbers reach the driver.

    Each group holds one row per task; a first sum over 16 sub-groups keeps that spread out.
    """

    def add(batches: Iterator, keys: tuple) -> Iterator:
        total = None
        for frame in batches:
            for body in frame["body"]:
                got = np.frombuffer(body, dtype)
                total = got.copy() if total is None else total + got
        import pandas as pd

        yield pd.DataFrame({"part": [keys[0]], "body": [total.tobytes()]})

    def summed(df: DataFrame, *by: str) -> DataFrame:
        def run(keys, frame):
            return next(add(iter([frame]), keys))

        return df.groupBy(*by).applyInPandas(run, SUM_SCHEMA)

    spread = rows.withColumn("sub", F.spark_partition_id() % 16)
    total = np.zeros(size, dtype)
    for row in summed(summed(spread, "part", "sub"), "part").collect():
        got = np.frombuffer(row["body"], dtype)
        total[row["part"] * CHUNK : row["part"] * CHUNK + len(got)] = got
    return total


# -- bounded samples ---------------------------------------------------------


def drawn(rows: DataFrame, keys: list[str], share: Column) -> DataFrame:
    """About 1.25 times this share of the rows, by ``draw``, a hash of their keys; rows with equal keys count once."""
    draw = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit("sample"))
    some = rows.withColumn("draw", draw).where(F.pmod("draw", F.lit(1_000_000)) / 1_000_000 < 1.25 * share)
    return some.dropDuplicates(["draw"])


# -- rows told apart ---------------------------------------------------------


def row_ids(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The frame (with a column doc_id) and ``rid``, a number of each row that no re-run changes.

    Where the ids are integers, never null and never repeated they serve themselves; otherwise the
    rows are numbered and written, so that a lost task can't number them anew.
    """
    if df.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        if not df.groupBy("doc_id").count().where("count > 1 or doc_id is null").take(1):
            return df.withColumn("rid", F.col("doc_id").cast("long"))
    return stage(spark, df.withColumn("rid", F.monotonically_increasing_id()), "rows")


def tracked(spark: SparkSession, df: DataFrame, doc_id: str, text: str):
    """(rows, restore): columns c0, c1, .. with rid, doc_id and text; restore() gives any part of them its columns back."""
    names = df.columns
    rows = numbered(df).withColumn("doc_id", F.col(f"c{names.index(doc_id)}"))
    rows = row_ids(spark, rows).withColumn("text", F.col(f"c{names.index(text)}"))

    def restore(part: DataFrame) -> DataFrame:
        return part.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)

    return rows, restore
