"""Dimension joins with a measured broadcast.

A dimension is broadcast only after it has been shown to hold at most
``max_rows`` rows and ``max_bytes`` bytes, by one aggregate over it (a count and a
byte sum).  A larger frame is returned as it is and Spark plans a shuffle join
(sort-merge, with AQE skew splitting for hot keys) instead.  Every call measures
anew, so a dimension that has grown since is never broadcast on an old figure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {
    BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, FloatType: 4,
    DateType: 4, LongType: 8, DoubleType: 8, TimestampType: 8, TimestampNTZType: 8,
}


@dataclass(frozen=True)
class SizeCheck:
    rows: int
    bytes: int
    capped: bool  # True when the row cap was hit (the frame may be larger)

    def fits(self, max_rows: int, max_bytes: int) -> bool:
        return (not self.capped) and self.rows <= max_rows and self.bytes <= max_bytes


def _width(name: str, dtype: DataType) -> Column:
    for klass, width in _FIXED_WIDTH.items():
        if isinstance(dtype, klass):
            return F.lit(width)
    if isinstance(dtype, StringType):
        return F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + F.lit(4)
    # Nested / binary / decimal values: measure their JSON-ish text form.
    return F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + F.lit(8)


def measure(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> SizeCheck:
    """Count rows and payload bytes in one aggregate, partial in every task: one row reaches the driver."""
    cols = [_width(f.name, f.dataType) for f in df.schema.fields]
    row_bytes = sum(cols[1:], cols[0]) if cols else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b")).first()
    rows = int(row["n"])
    return SizeCheck(rows=rows, bytes=int(row["b"] or 0), capped=rows > max_rows)


MAX_ROWS_CONF = "paddock.broadcast.maxRows"
MAX_BYTES_CONF = "paddock.broadcast.maxBytes"


def caps(df: DataFrame) -> tuple[int, int]:
    """Row and byte caps: session settings if given, else the defaults."""
    conf = df.sparkSession.conf
    return (int(conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS))),
            int(conf.get(MAX_BYTES_CONF, str(DEFAULT_MAX_BYTES))))


def dimension(
    df: DataFrame,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Mark ``df`` for broadcast if it is provably small, else return it as is.

    Caps default to the session settings ``paddock.broadcast.maxRows`` and
    ``paddock.broadcast.maxBytes`` (2,000,000 rows and 64 MiB when unset).
    """
    if df.isStreaming:
        return df  # a stream has no size to prove; it stays the streamed side
    conf_rows, conf_bytes = caps(df)
    max_rows = conf_rows if max_rows is None else max_rows
    max_bytes = conf_bytes if max_bytes is None else max_bytes
    check = measure(df, max_rows)
    return F.broadcast(df) if check.fits(max_rows, max_bytes) else df
