"""High-watermark filters.

The contract is *strict*: a row is new only if its key is greater than the
target's maximum.  Rows that tie the maximum, and late rows below it, are never
loaded.  One deliberate change: an empty target (maximum is NULL) means "load
everything" instead of "load nothing forever".
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType


def high_watermark(target: DataFrame, column: str = "date") -> DataFrame:
    """One-row frame ``(watermark)`` = max of ``column`` over the target.

    Column pruning reduces the scan to the single key column and the partial
    aggregate runs in every scan task, so only one value per task is shuffled.
    """
    return target.agg(F.max(column).alias("watermark"))


def watermark_subquery(target: DataFrame, column: str = "date") -> Column:
    """The target's maximum as an uncorrelated scalar subquery column."""
    return target.agg(F.max(column)).scalar()


def newer_than(
    source: DataFrame,
    target: DataFrame,
    column: str = "date",
    full_load_when_empty: bool = True,
) -> DataFrame:
    """Rows of ``source`` strictly newer than ``max(target.column)``.

    The maximum, one value, is read first, in a form that no time zone touches; the
    literal is then pushed into the source's scan.  An empty target means a full load
    (NULL keys included), or no rows.
    """
    dtype = target.schema[column].dataType
    top = F.max(column)
    if isinstance(dtype, TimestampType):
        top = F.unix_micros(top)
    elif isinstance(dtype, TimestampNTZType):
        top = top.cast("string")
    value = target.agg(top).first()[0]
    if value is None:
        return source if full_load_when_empty else source.where(F.lit(False))
    literal = F.timestamp_micros(F.lit(value)) if isinstance(dtype, TimestampType) else F.lit(value)
    return source.where(F.col(column) > literal.cast(dtype))


def typed_literal(value, dtype: DataType) -> Column:
    """A literal of the column's own type, built without any time-zone step.

    A wall-clock ``TIMESTAMP_NTZ`` value goes through its text form (a zone-free
    cast); every other value is a plain literal cast to the column type.
    """
    if isinstance(dtype, TimestampNTZType) and isinstance(value, datetime):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def newer_than_value(source: DataFrame, column: str, watermark) -> DataFrame:
    """Same filter with an already known watermark value.

    A literal (unlike a subquery) is pushed into the scan, so Parquet row
    groups and CSV rows below it are skipped at read time.  ``None`` = full load.
    """
    if watermark is None:
        return source
    if not isinstance(watermark, Column):
        watermark = typed_literal(watermark, source.schema[column].dataType)
    return source.where(F.col(column) > watermark)


def newer_than_sql(
    spark: SparkSession,
    source_view: str,
    target_view: str,
    column: str = "date",
) -> DataFrame:
    """The SQL form: ``WHERE col > (SELECT max(col) FROM target)``.

    Kept faithful to the SQL model, i.e. an empty target yields no rows.
    """
    return spark.sql(
        f"SELECT * FROM {source_view} "
        f"WHERE {column} > (SELECT max({column}) FROM {target_view})"
    )
