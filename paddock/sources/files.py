"""CSV sources with fixed schemas, and the matching CSV export used by tests.

Schemas are never inferred.  By default the header is checked against the
schema (``enforceSchema=false``): a file whose header names or order differ
from the schema fails the read instead of being silently misread.  Pass
``positional=True`` to bind columns by position and skip the header, which is
what a reader with an enforced schema does.  Malformed fields become NULL and
the row is kept (PERMISSIVE).
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from paddock.schemas import car_schema, driver_schema, session_schema

# --- fixed values: text formats for exported timestamps (microseconds kept) ----
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def path_exists(spark: SparkSession, path: str) -> bool:
    """There is a file or folder of this name, wherever the path's own file system keeps it."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # a remote session: only a look at it can tell
        try:
            spark.read.format("binaryFile").load(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def literal_path(path: str) -> str:
    """The path with what a glob would take as a pattern escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    *,
    recursive: bool = False,
    header: bool = True,
    positional: bool = False,
    mode: str = "PERMISSIVE",
    timestamp_ntz_format: str | None = None,
    timestamp_format: str | None = None,
    modified_after: str | None = None,
    bad_line_column: str | None = None,
) -> DataFrame:
    """Read CSV text with a fixed schema.

    ``recursive=True`` lists every file below ``path`` (no partition
    discovery); otherwise ``path`` may be a file, a folder or a glob such as
    ``dir/*.csv``.

    ``modified_after`` (``YYYY-MM-DDTHH:mm:ss``, session time zone) skips files
    last modified before it, at listing time.  A daily run that passes its
    previous run's start then parses only new files instead of the whole raw
    history; the result equals a full read when raw files are written once and
    never appended to later (rows newer than the watermark only arrive in new
    files).
    """
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", positional)
        .option("mode", mode)
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if timestamp_ntz_format:
        reader = reader.option("timestampNTZFormat", timestamp_ntz_format)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if bad_line_column:
        reader = reader.option("columnNameOfCorruptRecord", bad_line_column)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.csv(path)


#: Holds the whole line of a row with a field that its column's type can't hold, or with a wrong number of fields.
BAD_LINE = "_bad_line"


def read_car_csv(
    spark: SparkSession,
    path: str | list[str],
    layout: str = "A",
    *,
    recursive: bool = True,
    ts_type: DataType | None = None,
    bad_lines: bool = False,
    **options,
) -> DataFrame:
    """Car telemetry files: a folder tree (``recursive``), a one-level glob, or a list of files.

    ``bad_lines`` adds ``BAD_LINE`` and the file that a row comes from, for ``ingest.run_ingest`` to set
    bad lines aside; every field of every line is then parsed, whatever columns are read.
    """
    schema = car_schema(layout, ts_type)
    if not bad_lines:
        return read_csv(spark, path, schema, recursive=recursive, **options)
    car = read_csv(spark, path, schema.add(BAD_LINE, "string"), recursive=recursive, bad_line_column=BAD_LINE, **options)
    return car.select("*", F.col("_metadata.file_path").alias("_file"))


def read_drivers(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, driver_schema(), **options)


def read_sessions(spark: SparkSession, path: str, ts_type: DataType | None = None, **options) -> DataFrame:
    return read_csv(spark, path, session_schema(ts_type), **options)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    columns: list[str] | None = None,
    nest_by: str | None = None,
    mode: str = "errorifexists",
) -> None:
    """Export ``df`` as headed CSV with microsecond timestamps.

    ``nest_by`` names a column of ``df`` (not among ``columns``) whose values
    become one sub-folder level (``<col>=<value>/part-*.csv``); it gives a
    folder tree to read back recursively and is not written into the files.
    """
    cols = list(columns or [c for c in df.columns if c != nest_by])
    out = df.select(*cols, *([nest_by] if nest_by else []))
    w = (
        out.write.mode(mode)
        .option("header", True)
        .option("timestampNTZFormat", TS_NTZ_FORMAT)
        .option("timestampFormat", TS_FORMAT)
    )
    if nest_by:
        w = w.partitionBy(nest_by)
    w.csv(path)
