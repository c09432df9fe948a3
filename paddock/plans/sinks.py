"""Table sinks: create, append, full refresh, upsert and schema sync.

Two kinds of table are handled:

- **file tables** (provider parquet / orc / ...) in the built-in catalog: the
  tested path.  They have no MERGE and no DROP COLUMN, so upsert rewrites only
  the touched partitions with dynamic partition overwrite, and a schema sync
  rewrites the table from an aligned copy.
- **V2 tables** (a table format with its own catalog): the same calls go
  through ``DataFrameWriterV2`` and ``DataFrame.mergeInto``.  No such format is
  installed on the test machine, so that branch is not exercised by the tests.

Before a table is overwritten from data that was read from it, the data is
checkpointed into the shared checkpoint folder (``spark.checkpoint.dir``) so
the write no longer depends on files it replaces.  Partitioned writes are
rebalanced on the partition columns first: AQE splits a hot partition value
over several tasks and merges small ones, so each task writes few files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paddock.operators.checks import duplicate_keys
from paddock.operators.merge import upsert_rows
from paddock.session import checkpoint_root, scratch_path
from paddock.sources.files import path_exists

FILE_PROVIDERS = {"parquet", "orc", "csv", "json", "avro", "text"}


# --- catalog helpers ----------------------------------------------------------------

def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _table_detail(spark: SparkSession, name: str, key: str) -> str | None:
    detailed = False  # the table's own columns come first, and one of them may be called like the key
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        title = (row["col_name"] or "").strip().lower()
        detailed = detailed or title == "# detailed table information"
        if detailed and title == key:
            return (row["data_type"] or "").strip()
    return None


def table_provider(spark: SparkSession, name: str) -> str | None:
    p = _table_detail(spark, name, "provider")
    return p.lower() if p else None


def table_location(spark: SparkSession, name: str) -> str | None:
    return _table_detail(spark, name, "location")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def partition_values(spark: SparkSession, name: str, column: str) -> list[str]:
    """Registered values of one partition column, from the catalog (no job).

    NULL partitions are left out.  Values are the folder-name text.
    """
    from urllib.parse import unquote

    out = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        for part in row[0].split("/"):
            key, _, value = part.partition("=")
            if key == column and value != "__HIVE_DEFAULT_PARTITION__":
                out.append(unquote(value))
    return out


def is_file_table(spark: SparkSession, name: str) -> bool:
    return (table_provider(spark, name) or "parquet") in FILE_PROVIDERS


def attach_if_present(spark: SparkSession, name: str, path: str | None, fmt: str = "parquet") -> bool:
    """Register an existing table folder under ``name`` if the catalog lacks it.

    With Spark's in-memory catalog a table disappears when the process ends;
    a scheduled job started anew finds yesterday's table at its location and
    re-attaches it (schema and partition columns are read from the folder,
    then the partitions are registered).  Returns True if it attached one.
    """
    if not path or table_exists(spark, name) or not path_exists(spark, path):
        return False
    try:
        spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # no data files in the folder
            return False
        raise
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    if partition_columns(spark, name):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return True


def cluster_for_write(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Group rows by output partition before a partitioned file write."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def detach(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_parquet(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` as Parquet into a new folder under the checkpoint root and
    read it back: the lineage is cut like ``detach``, but the copy is columnar
    and compressed, which matters when a whole large table is staged."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- K1 / K2 / K3: create, append, create-or-append -------------------------------------

def create_table(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str] = (),
    fmt: str = "parquet",
    path: str | None = None,
) -> None:
    """Create a (partitioned) table from ``df``; fails if it already exists."""
    if fmt in FILE_PROVIDERS:
        w = cluster_for_write(df, partition_cols).write.format(fmt).mode("errorifexists")
        if partition_cols:
            w = w.partitionBy(*partition_cols)
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
    else:
        w2 = df.writeTo(name).using(fmt)
        if partition_cols:
            w2 = w2.partitionedBy(*[F.col(c) for c in partition_cols])
        w2.create()


def _refuse_extra(source: DataFrame, table_cols: Sequence[str], name: str) -> None:
    """Columns that a table lacks are an error: leaving them out would lose data silently."""
    known = {c.lower() for c in table_cols}
    extra = [c for c in source.columns if c.lower() not in known]
    if extra:
        raise ValueError(f"table {name} has no columns {extra}; sync its schema first, or ignore them explicitly")


def append(df: DataFrame, name: str, ignore_extra: bool = False) -> None:
    """Append ``df`` to an existing table; columns are matched by name.

    Columns that the table lacks are refused unless ``ignore_extra``.  The table's
    own partitioning applies; it is read from the catalog.
    """
    spark = df.sparkSession
    provider = table_provider(spark, name) or "parquet"
    if provider in FILE_PROVIDERS:
        parts = partition_columns(spark, name)
        table_cols = spark.table(name).columns
        if not ignore_extra:
            _refuse_extra(df, table_cols, name)
        ordered = df.select(*table_cols)
        w = cluster_for_write(ordered, parts).write.mode("append").format(provider)
        if parts:
            w = w.partitionBy(*parts)  # must restate the table's own spec
        w.saveAsTable(name)
    else:
        df.writeTo(name).append()


def create_or_append(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str] = (),
    fmt: str = "parquet",
    path: str | None = None,
) -> bool:
    """Append when the table exists, else create it.  Returns True if created."""
    if table_exists(df.sparkSession, name):
        append(df, name)
        return False
    create_table(df, name, partition_cols, fmt, path)
    return True


# --- K7: full refresh ------------------------------------------------------------------------

def refresh(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str] = (),
    fmt: str = "parquet",
    path: str | None = None,
) -> None:
    """Replace all rows (and the schema) of ``name`` with ``df``."""
    spark = df.sparkSession
    exists = table_exists(spark, name)
    if exists and not is_file_table(spark, name):
        w2 = df.writeTo(name)
        if partition_cols:
            w2 = w2.partitionedBy(*[F.col(c) for c in partition_cols])
        w2.createOrReplace()
        return
    if exists and path is None and _table_detail(spark, name, "type") == "EXTERNAL":
        path = table_location(spark, name)  # keep an external table where it is
    w = cluster_for_write(df, partition_cols).write.format(fmt).mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if path:
        w = w.option("path", path)
    # All rows go, whatever the session says about partitions that get no new ones.
    with _overwrite_mode(spark, "STATIC"):
        w.saveAsTable(name)


# --- K9 / K10: incremental merge (upsert) ---------------------------------------------------------

# At most this many touched partition values are turned into a literal
# partition filter; beyond it the touched set is applied as a semi-join
# (the same rows, without planning-time pruning).
MAX_PRUNING_VALUES = 10_000


def upsert(
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    partition_col: str = "date",
    *,
    null_safe: bool = False,
    check_keys: bool = True,
    path: str | None = None,
    checkpoint_source: bool = True,
    on_schema_change: str = "fail",
) -> None:
    """Insert new keys and replace matched rows of ``name`` by ``source``.

    ``on_schema_change="sync_all_columns"`` first aligns the table's columns
    with the source's (see ``sync_all_columns``); ``"fail"`` refuses columns that
    the table lacks, ``"ignore"`` leaves them out.

    File tables must be partitioned by ``partition_col``, which must be one of
    the keys: a key can then only match inside its own partition, and only the
    partitions that ``source`` touches are read and rewritten.

    Plan: the source is materialised once in the checkpoint folder (it is
    used three times: key check, touched partitions, merge).  Its distinct
    partition values -- one per touched day -- become a literal partition
    filter on the target scan.  The merged rows are checkpointed too, because
    they are read from the very partitions that the overwrite replaces.

    Source keys must be unique (a MERGE would refuse a double match; an
    anti-join would silently keep both), so they are checked first.
    """
    spark = source.sparkSession
    if partition_col not in keys:
        raise ValueError(f"partition column {partition_col!r} must be one of the keys {list(keys)}")
    attach_if_present(spark, name, path)
    exists = table_exists(spark, name)
    if exists and on_schema_change == "sync_all_columns":
        sync_all_columns(spark, name, source.schema)
    if exists and not is_file_table(spark, name):
        if check_keys and not duplicate_keys(source, list(keys), include_nulls=null_safe).isEmpty():
            raise ValueError(f"upsert source has duplicate keys {list(keys)}")
        op = "<=>" if null_safe else "="
        cond = F.expr(" AND ".join(f"{name}.{k} {op} s.{k}" for k in keys))
        (
            source.alias("s").mergeInto(name, cond)
            .whenMatched().updateAll()
            .whenNotMatched().insertAll()
            .merge()
        )
        return

    table_cols = spark.table(name).columns if exists else source.columns
    if on_schema_change != "ignore":
        _refuse_extra(source, table_cols, name)
    src = source.select(*table_cols)
    if checkpoint_source:
        # Skipped only by callers whose source is a cheap step over data that
        # is already materialised in the checkpoint folder.
        src = detach(src)
    if check_keys and not duplicate_keys(src, list(keys), include_nulls=null_safe).isEmpty():
        raise ValueError(f"upsert source has duplicate keys {list(keys)}")
    touched, null_part = _touched_partitions(src, partition_col) if exists else (None, False)
    if not exists:
        create_table(src, name, [partition_col], path=path)
        return

    target = spark.table(name)
    if touched is not None:
        cond = F.col(partition_col).isin(touched) if touched else F.lit(False)
        if null_part:
            cond = cond | F.col(partition_col).isNull()
        affected = target.where(cond)
    else:
        touched_df = src.select(partition_col).distinct()
        affected = target.join(
            touched_df, target[partition_col].eqNullSafe(touched_df[partition_col]), "left_semi"
        )
    staged = detach(upsert_rows(affected, src, keys, null_safe))
    replace_partitions(staged, name, [partition_col])


def replace_partitions(df: DataFrame, name: str, partition_cols: Sequence[str]) -> None:
    """Replace those partitions of a file table that ``df`` has rows for; the others stay.

    ``df`` must not read the table itself (see ``detach``).
    """
    table_cols = df.sparkSession.table(name).columns
    _refuse_extra(df, table_cols, name)
    writer = cluster_for_write(df.select(*table_cols), partition_cols).write.mode("overwrite")
    with _overwrite_mode(df.sparkSession, "DYNAMIC"):
        writer.insertInto(name)


def _touched_partitions(src: DataFrame, partition_col: str) -> tuple[list | None, bool]:
    """(touched non-NULL partition values, or None if more than
    MAX_PRUNING_VALUES; whether the NULL partition is touched).

    A distributed ``distinct`` with a bounded fetch: at most
    ``MAX_PRUNING_VALUES + 1`` values ever reach the driver, and when there
    are more the caller switches to an exact semi-join instead.
    """
    values = [r[0] for r in src.select(partition_col).distinct().limit(MAX_PRUNING_VALUES + 2).collect()]
    present = [v for v in values if v is not None]
    null_part = len(present) < len(values)
    if len(present) > MAX_PRUNING_VALUES:
        return None, null_part
    return present, null_part


class _overwrite_mode:
    """The session's partition overwrite mode for one write.

    Not a writer option: ``saveAsTable`` would keep it with the table, where it
    overrides the mode of every later write.
    """

    key = "spark.sql.sources.partitionOverwriteMode"

    def __init__(self, spark: SparkSession, mode: str):
        self.spark, self.mode = spark, mode

    def __enter__(self):
        self.old = self.spark.conf.get(self.key, "STATIC")
        self.spark.conf.set(self.key, self.mode)

    def __exit__(self, *exc):
        self.spark.conf.set(self.key, self.old)
        return False


# --- K11: schema sync (add new, drop missing, retype changed) ------------------------------------

@dataclass
class SchemaChange:
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    retyped: list[str] = field(default_factory=list)

    @property
    def empty(self) -> bool:
        return not (self.added or self.removed or self.retyped)


def schema_change(old: StructType, new: StructType) -> SchemaChange:
    old_types = {f.name: f.dataType for f in old.fields}
    new_types = {f.name: f.dataType for f in new.fields}
    return SchemaChange(
        added=[c for c in new_types if c not in old_types],
        removed=[c for c in old_types if c not in new_types],
        retyped=[c for c in new_types if c in old_types and old_types[c] != new_types[c]],
    )


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Select ``schema``'s columns from ``df``: cast present ones, NULL for new ones."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


# Columns that a table's files hold but its definition doesn't any more.
DROPPED = "paddock.dropped"


def _dropped(spark: SparkSession, name: str) -> list[str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return json.loads(next((r["value"] for r in rows if r["key"] == DROPPED), "[]"))


def _redefine(spark: SparkSession, name: str, change: SchemaChange, new_schema: StructType) -> bool:
    """Drop (and add) columns of an external table by defining it anew over the same files; False if it can't be.

    The files keep the dropped columns, which the new definition doesn't read.  So that
    none comes back to life, their names are kept with the table: when one is added again, or
    a column changes its type or is one that the table is partitioned by, the caller rewrites
    the files.  The new definition is made under another name first and then takes the old one's place.
    """
    gone, partitions = _dropped(spark, name), partition_columns(spark, name)
    back = {c.lower() for c in change.added} & {c.lower() for c in [*gone, *change.removed]}
    fixed = (table_provider(spark, name) or "parquet") not in ("parquet", "orc")  # columns of text files go by place
    if name.count(".") > 1:  # a table can't be renamed by a name with its catalog in it
        return False
    if change.retyped or back or fixed or set(change.removed) & set(partitions) or _table_detail(spark, name, "type") != "EXTERNAL":
        return False
    made, location, provider = f"{name}_{uuid.uuid4().hex[:8]}", table_location(spark, name), table_provider(spark, name)
    # partition columns come last, as everywhere
    fields = [f for f in new_schema.fields if f.name not in partitions] + [new_schema[c] for c in partitions]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions else ""
    properties = f"TBLPROPERTIES ('{DROPPED}' = '{json.dumps(sorted({*gone, *change.removed}))}')"
    spark.sql(f"CREATE TABLE {made} ({columns}) USING {provider} {by} LOCATION '{location}' {properties}")
    if partitions:
        spark.sql(f"ALTER TABLE {made} RECOVER PARTITIONS")
    spark.sql(f"DROP TABLE {name}")  # external: its files stay
    spark.sql(f"ALTER TABLE {made} RENAME TO {name}")
    return True


def sync_all_columns(
    spark: SparkSession,
    name: str,
    new_schema: StructType,
    path: str | None = None,
) -> SchemaChange:
    """Make table ``name`` carry exactly ``new_schema``'s columns.

    Existing rows get NULL in added columns; removed columns are dropped;
    retyped columns are cast (a value that does not convert fails the job
    rather than being lost).  Partition columns stay partition columns.  On a
    file table, added columns alone are a metadata change (no data is read or
    written), and so are drops on an external one (``_redefine``); a retype
    rewrites the table from a staged Parquet copy.
    """
    target = spark.table(name)
    change = schema_change(target.schema, new_schema)
    if change.empty:
        return change
    if not is_file_table(spark, name):
        for c in change.added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMN {c} {new_schema[c].dataType.simpleString()}")
        for c in change.removed:
            spark.sql(f"ALTER TABLE {name} DROP COLUMN {c}")
        for c in change.retyped:
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN {c} TYPE {new_schema[c].dataType.simpleString()}")
        return change
    if not change.removed and not change.retyped and not {c.lower() for c in change.added} & {c.lower() for c in _dropped(spark, name)}:
        # Additions only: a metadata change; old files read the new columns as NULL.
        cols = ", ".join(f"`{c}` {new_schema[c].dataType.simpleString()}" for c in change.added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
        return change
    parts = [c for c in partition_columns(spark, name) if c in new_schema.fieldNames()]
    if _redefine(spark, name, change, new_schema):
        return change
    staged = stage_parquet(align_to_schema(target, new_schema), "schema-sync")
    refresh(staged, name, parts, table_provider(spark, name) or "parquet", path=path)
    return change
