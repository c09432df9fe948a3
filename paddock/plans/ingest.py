"""The end-to-end ingest run: new car rows -> star join -> partitioned table.

One run is one pass over the raw files:

1. If the target exists, its ``max(date)`` and row count are taken from what
   earlier runs noted of the files they wrote (``FactTotals``); only files that
   others wrote are read for them.  The value is carried in a zone-free form
   (epoch microseconds, or wall-clock text for TIMESTAMP_NTZ) and turned back
   into a literal inside the plan, so no time zone touches it and it is
   pushed into the file scan.
2. Rows strictly newer than that watermark are joined to the dimensions and
   written (create on the first run, append afterwards).  Two observations
   taken *during* the write report the new fact rows before the joins and the
   rows written, so no extra count scans the input.
3. The new watermark is the larger of the old one and the written rows'
   observed maximum, the table total the old one and the rows written, so the
   table is not read again.  Observed metrics count successful task attempts
   only (tested with injected task failures).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from paddock.operators.enrich import enrich
from paddock.plans import sinks, speed_state
from paddock.plans.file_ledger import Changes, FileLedger, listing
from paddock.schemas import car_schema
from paddock.sources.files import BAD_LINE, literal_path, read_car_csv


@dataclass
class RunReport:
    table: str
    created: bool
    watermark_before: datetime | None
    new_fact_rows: int
    rows_written: int
    table_rows: int
    watermark_after: datetime | None
    # The fact's watermark after the run in its zone-free form (``watermark_token``).
    token_after: int | str | None = None
    # Lines set aside, None if they weren't looked for.
    bad_lines: int | None = None

    @property
    def wrote(self) -> bool:
        return self.created or self.rows_written > 0

    def as_dict(self) -> dict:
        left_out = {"token_after"} | ({"bad_lines"} if self.bad_lines is None else set())
        return {k: v for k, v in asdict(self).items() if k not in left_out}


def watermark_token(df: DataFrame, column: str) -> tuple[int | str | None, int]:
    """``(max(column), count)`` with the maximum in a zone-free form.

    TIMESTAMP (an instant) travels as epoch microseconds; TIMESTAMP_NTZ (a
    wall-clock value) as its text.  Neither passes through the driver's or the
    session's time zone, so the value written back into the plan is exact.
    """
    token = _max_token(column, df.schema[column].dataType)
    row = df.agg(token.alias("wm"), F.count(F.lit(1)).alias("n")).first()
    return row["wm"], int(row["n"])


def table_watermark(
    spark: SparkSession, table: str, column: str = "date", year_from_date: bool = True
) -> tuple[int | str | None, int]:
    """``(watermark token, row count)`` of a fact table.

    When the table is partitioned by ``year`` (derived from ``column``), the
    maximum lies in the latest year: that partition alone is read for it, the
    year list coming from the catalog.  The row count reads no columns.  An
    empty latest partition (possible after manual deletes) falls back to the
    full column scan, so the result is always the true maximum.  The shortcut
    is used only when ``year`` is known to be ``year(column)`` (``year_from_date``).
    """
    t = spark.table(table)
    n = t.count()
    if n == 0:
        return None, 0
    if year_from_date and "year" in sinks.partition_columns(spark, table):
        years = [int(v) for v in sinks.partition_values(spark, table, "year") if v.lstrip("-").isdigit()]
        if years:
            token, _ = watermark_token(t.where(F.col("year") == max(years)), column)
            if token is not None:
                return token, n
    token, _ = watermark_token(t, column)
    return token, n


class FactTotals:
    """Row count and watermark of a fact table by a ledger of its files, without reading what is known.

    Every run that wrote files is noted with their rows and their largest date, as observed during the
    write.  Files that others wrote are read once, when they are first met; files that went take
    their run's note with them.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table, self.location = spark, table, sinks.table_location(spark, table)
        self.ledger = FileLedger(spark, f"{self.location}_totals")
        self.history = self.ledger.history()

    def _changes(self) -> Changes:
        return self.ledger.changes(listing(self.spark, self.location), self.history)

    def _note(self, changes: Changes, token: int | str | None, rows: int) -> None:
        run = self.ledger.new_run() if changes.fresh else None
        self.history += self.ledger.commit(changes, run, json.dumps([token, rows]) if run else None)

    def current(self) -> tuple[int | str | None, int]:
        """``(watermark token, row count)`` of the table as it is now."""
        if changes := self._changes():
            fresh = speed_state.scan_files(self.spark, self.table, changes.fresh)
            self._note(changes, *(watermark_token(fresh, "date") if changes.fresh else (None, 0)))
        notes = [json.loads(e.note) for e in self.ledger.in_force(self.history)]
        return max((t for t, _ in notes if t is not None), default=None), sum(n for _, n in notes)

    def wrote(self, token: int | str | None, rows: int) -> None:
        """Note the files that have come since ``current`` as this run's."""
        if changes := self._changes():
            self._note(changes, token, rows)


def token_literal(token: int | str, dtype: DataType) -> Column:
    if isinstance(token, str):
        return F.lit(token).cast(dtype)
    return F.timestamp_micros(F.lit(token)).cast(dtype)


def observed(obs: Observation) -> dict | None:
    """The observed metrics, or None when the observed node never ran.

    AQE replaces a plan whose input turned out empty by an empty relation, and
    the observation inside it is then never reported.
    """
    try:
        return obs.get
    except Exception:  # noqa: BLE001 - reported as a JVM assertion
        return None


def _max_token(column: str, dtype: DataType) -> Column:
    """``max(column)`` in the zone-free token form (see ``watermark_token``)."""
    m = F.max(F.col(column))
    return m.cast("string") if isinstance(dtype, TimestampNTZType) else F.unix_micros(m)


def token_to_datetime(spark: SparkSession, token: int | str | None, dtype: DataType) -> datetime | None:
    """The watermark for display (no Spark job): wall-clock text as is, an
    instant as wall-clock time in the session's zone, wherever the driver is."""
    if token is None:
        return None
    if isinstance(token, str):
        return datetime.fromisoformat(token)
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone", "UTC"))
    return datetime.fromtimestamp(token // 1_000_000, zone).replace(tzinfo=None, microsecond=token % 1_000_000)


def run_ingest(
    spark: SparkSession,
    car: DataFrame,
    drivers: DataFrame,
    sessions: DataFrame,
    table: str,
    *,
    partition_cols: Sequence[str] = ("year", "location", "full_name"),
    add_year: bool = True,
    driver_keys: Sequence[str] = ("driver_number",),
    fmt: str = "parquet",
    path: str | None = None,
    on_schema_change: str = "fail",
    bad_lines: str | None = None,
    bad_lines_path: str | None = None,
) -> RunReport:
    """Load car rows newer than the table's watermark into ``table``.

    ``bad_lines`` names a table that lines with bad fields are copied to, once each, when ``car`` was
    read with them (``read_car_csv(.., bad_lines=True)``).  In the fact such a row is as without it:
    NULL in the bad fields, and left out if its date is one of them.

    A run that finds none leaves an existing table as it is: no file, no schema change.

    ``on_schema_change="sync_all_columns"`` first makes an existing table carry
    exactly the new rows' columns (added ones NULL for old rows, removed ones
    dropped, retyped ones cast); ``"fail"`` refuses columns that the table lacks,
    ``"ignore"`` leaves them out.
    """
    if bad_lines is not None:
        found = set_aside(car, bad_lines, bad_lines_path)
        report = run_ingest(spark, car.drop(BAD_LINE, "_file"), drivers, sessions, table, partition_cols=partition_cols, add_year=add_year,
                            driver_keys=driver_keys, fmt=fmt, path=path, on_schema_change=on_schema_change)
        report.bad_lines = found
        return report
    date_type = car.schema["date"].dataType
    sinks.attach_if_present(spark, table, path, fmt)
    exists = sinks.table_exists(spark, table)
    wm_token, rows_before, totals = None, 0, None
    if exists and sinks.is_file_table(spark, table):
        totals = FactTotals(spark, table)
        wm_token, rows_before = totals.current()
    elif exists:
        wm_token, rows_before = table_watermark(spark, table, year_from_date=add_year)
    new = car
    if wm_token is not None:
        # Strict '>': a row that ties the watermark, or is older, is skipped.
        new = car.where(F.col("date") > token_literal(wm_token, date_type))
    if exists and new.isEmpty():
        # The gate: reading stops at the first new row; without one nothing is committed.
        at = token_to_datetime(spark, wm_token, date_type)
        return RunReport(table, False, at, 0, 0, rows_before, at, wm_token)

    obs_new = Observation("new_fact_rows")
    obs_out = Observation("rows_written")
    new = new.observe(obs_new, F.count(F.lit(1)).alias("n"))
    enriched = enrich(new, drivers, sessions, driver_keys=driver_keys, add_year=add_year)
    enriched = enriched.observe(
        obs_out, F.count(F.lit(1)).alias("n"), _max_token("date", date_type).alias("wm")
    )

    if exists:
        if on_schema_change == "sync_all_columns":
            sinks.sync_all_columns(spark, table, enriched.schema)
        sinks.append(enriched, table, ignore_extra=on_schema_change == "ignore")
    else:
        sinks.create_table(enriched, table, partition_cols, fmt, path)

    watermark_before = token_to_datetime(spark, wm_token, date_type)
    written = observed(obs_out)
    if written is not None:
        # The written rows' own count and maximum move total and watermark: the
        # table is not read again.
        rows_written = int(written["n"])
        rows_after = rows_before + rows_written
        token_after = max((t for t in (wm_token, written["wm"]) if t is not None), default=None)
        if sinks.is_file_table(spark, table):
            (totals or FactTotals(spark, table)).wrote(written["wm"], rows_written)
    else:
        token_after, rows_after = table_watermark(spark, table, year_from_date=add_year)
        rows_written = rows_after - rows_before
    watermark_after = token_to_datetime(spark, token_after, date_type)
    new_obs = observed(obs_new)
    # Missing only when AQE dropped the observed node (an empty side made the
    # whole join empty); then the filtered input is counted directly.
    new_rows = int(new_obs["n"]) if new_obs is not None else new.count()
    return RunReport(
        table=table,
        created=not exists,
        watermark_before=watermark_before,
        new_fact_rows=new_rows,
        rows_written=rows_written,
        table_rows=rows_after,
        watermark_after=watermark_after,
        token_after=token_after,
    )


def set_aside(car: DataFrame, table: str, path: str | None = None) -> int:
    """Copy bad lines that the table doesn't hold yet to it; returns how many came.

    Columns: ``file``, ``line`` and ``fields``, the number of fields that could be read.

    A line that a file holds twice is one.  Without any no table is made.
    """
    spark = car.sparkSession
    fields = [F.col(c).isNotNull().cast("int") for c in car.columns if c not in (BAD_LINE, "_file")]
    bad = car.where(F.col(BAD_LINE).isNotNull()).select(
        F.col("_file").alias("file"), F.col(BAD_LINE).alias("line"), sum(fields[1:], fields[0]).alias("fields")
    ).distinct()
    sinks.attach_if_present(spark, table, path)
    if sinks.table_exists(spark, table):
        bad = bad.join(spark.table(table), ["file", "line"], "left_anti")
    # few as they are, they are staged, so that the raw files are parsed for them once
    staged = sinks.stage_parquet(bad, "bad-lines")
    n = staged.count()
    if n:
        sinks.create_or_append(staged, table, path=path)
    return n


def refresh_daily_models(
    spark: SparkSession,
    fact_table: str,
    average_speed_table: str,
    avg_speed_gear_table: str,
    *,
    since: datetime | date | int | str | None = None,
    path_average_speed: str | None = None,
    path_avg_speed_gear: str | None = None,
) -> None:
    """Upsert both daily aggregates from the fact table.

    By default every day is recomputed (each run re-reads the whole fact).
    With ``since`` (a watermark token, or a day) only days at or after ``since``'s day are recomputed and
    upserted; that is exact because a day's aggregate depends only on that
    day's rows.  The day bound is pushed into the fact scan, and when the fact
    is partitioned by ``year`` it also prunes older year partitions.  The fact
    is read once for both models: per-gear sums and counts are checkpointed
    and both aggregates are derived from them.
    """
    from paddock.operators import models
    from paddock.schemas import AVERAGE_SPEED_KEYS, AVG_SPEED_GEAR_KEYS

    fact = spark.table(fact_table)
    if since is not None:
        # The day is cut off inside Spark, in the session's zone like the models' own.
        date_type = fact.schema["date"].dataType
        day = F.lit(since.date() if isinstance(since, datetime) else since) if isinstance(since, date) else \
            F.to_date(token_literal(since, date_type))
        cond = F.col("date") >= day.cast(date_type)
        if "year" in sinks.partition_columns(spark, fact_table):
            cond = cond & (F.col("year") >= F.year(day))
        fact = fact.where(cond)
    # One pass over the fact feeds both models.
    partials = sinks.detach(models.speed_partials(fact))
    # Each model is a small step over the checkpointed partials, grouped by
    # exactly its keys, so its keys are unique by construction.
    sinks.upsert(models.average_speed_from_partials(partials), average_speed_table, AVERAGE_SPEED_KEYS,
                 path=path_average_speed, checkpoint_source=False, check_keys=False,
                 on_schema_change="sync_all_columns")
    sinks.upsert(models.avg_speed_gear_from_partials(partials), avg_speed_gear_table, AVG_SPEED_GEAR_KEYS,
                 path=path_avg_speed_gear, checkpoint_source=False, check_keys=False,
                 on_schema_change="sync_all_columns")


COVERED = "paddock.covered"


def covered(spark: SparkSession, model: str, fact_table: str) -> int | str | None:
    """The fact's watermark up to which an aggregate table was last brought up to date, or None.

    It is a table property that is set after the upsert committed, together with the
    fact's name.  None (no table, another fact, a table made or attached without it)
    means that nothing is known about the table.
    """
    if not sinks.table_exists(spark, model):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {model}").collect()
    kind, _, rest = next((r["value"] for r in rows if r["key"] == COVERED), "").partition("|")
    token, _, fact = rest.partition("|")
    if fact != fact_table:
        return None
    return int(token) if kind == "us" else token


def refresh_stale_models(
    spark: SparkSession,
    fact_table: str,
    average_speed_table: str,
    avg_speed_gear_table: str,
    token: int | str | None = None,
    *,
    incremental: bool = True,
    path_average_speed: str | None = None,
    path_avg_speed_gear: str | None = None,
) -> bool:
    """Bring both aggregates up to the fact, whose watermark is ``token``; True if anything was to do.

    What has to be recomputed follows from the fact's files and the aggregates' own
    recorded state (``speed_state``), not from the run's: an earlier run that died between
    fact and aggregates, a model added later, late rows and a rebuilt fact are made good.
    ``incremental=False`` recomputes every day from the whole fact.

    A table format with its own catalog doesn't show its files.  There the watermark
    that the aggregates were last brought up to decides: without a record of it every
    day is recomputed, else the days from the older record on.
    """
    if sinks.is_file_table(spark, fact_table):
        targets = speed_state.speed_models(average_speed_table, avg_speed_gear_table, path_average_speed, path_avg_speed_gear)
        return speed_state.refresh(spark, fact_table, targets, anew=not incremental)
    for name, path in ((average_speed_table, path_average_speed), (avg_speed_gear_table, path_avg_speed_gear)):
        sinks.attach_if_present(spark, name, path)
    models = (average_speed_table, avg_speed_gear_table)
    known = [covered(spark, m, fact_table) for m in models]
    if incremental and all(sinks.table_exists(spark, m) for m in models) and all(k == token for k in known):
        return False
    # a record beyond the fact's watermark belongs to rows that are gone
    usable = incremental and token is not None and all(type(k) is type(token) and k <= token for k in known)
    refresh_daily_models(
        spark, fact_table, average_speed_table, avg_speed_gear_table, since=min(known) if usable else None,
        path_average_speed=path_average_speed, path_avg_speed_gear=path_avg_speed_gear,
    )
    if token is not None:
        value = f"{'us' if isinstance(token, int) else 'text'}|{token}|{fact_table}"
        for m in models:
            spark.sql(f"ALTER TABLE {m} SET TBLPROPERTIES ('{COVERED}' = '{value}')")
    return True


@dataclass
class DailyTables:
    fact: str
    average_speed: str
    avg_speed_gear: str
    fact_path: str | None = None
    average_speed_path: str | None = None
    avg_speed_gear_path: str | None = None


def run_daily(
    spark: SparkSession,
    car: DataFrame,
    drivers: DataFrame,
    sessions: DataFrame,
    tables: DailyTables,
    *,
    partition_cols: Sequence[str] = ("year", "location", "full_name"),
    incremental_models: bool = True,
    add_year: bool = True,
    driver_keys: Sequence[str] = ("driver_number",),
    on_schema_change: str = "fail",
    fmt: str = "parquet",
) -> RunReport:
    """One scheduled run: ingest new car rows, then bring both aggregates up to date.

    With ``incremental_models`` only new files of the fact are read for them and only
    their days are made anew (``refresh_stale_models``); with
    ``incremental_models=False`` every day is recomputed from the whole fact.
    """
    report = run_ingest(spark, car, drivers, sessions, tables.fact, partition_cols=partition_cols,
                        add_year=add_year, driver_keys=driver_keys, path=tables.fact_path,
                        on_schema_change=on_schema_change, fmt=fmt)
    refresh_stale_models(
        spark, tables.fact, tables.average_speed, tables.avg_speed_gear, report.token_after, incremental=incremental_models,
        path_average_speed=tables.average_speed_path, path_avg_speed_gear=tables.avg_speed_gear_path,
    )
    return report


# --- raw files taken in once -------------------------------------------------------


class NewCarFiles:
    """The raw car files that no earlier run into this fact took in, by a ledger of all that were.

    A file counts by path, length and modification time: one that is copied late, keeps an old time or
    lies in another folder is new, whatever its date.  ``done`` enters the files into the ledger, after the run
    has committed.  A run that dies before is repeated over the same files, whose loaded rows the
    watermark then leaves out.  When the fact is gone or empty, every file is new.
    """

    def __init__(self, spark: SparkSession, ledger_root: str, fact: str, fact_path: str | None = None, fmt: str = "parquet"):
        self.spark, self.ledger = spark, FileLedger(spark, ledger_root)
        sinks.attach_if_present(spark, fact, fact_path, fmt)
        self.known = sinks.table_exists(spark, fact) and not spark.table(fact).where(F.col("date").isNotNull()).isEmpty()
        self.changes: Changes | None = None

    def read(self, path: str, layout: str = "A", *, recursive: bool = True, **options) -> DataFrame:
        now = listing(self.spark, path, recursive, pattern=not recursive)
        self.changes = self.ledger.unseen(now) if self.known else self.ledger.changes(now, self.ledger.history(), anew=True)
        if not self.changes.fresh:
            schema = car_schema(layout, options.get("ts_type"))
            if options.get("bad_lines"):
                schema = schema.add(BAD_LINE, "string").add("_file", "string")
            return self.spark.createDataFrame([], schema)
        return read_car_csv(self.spark, [literal_path(p) for p in self.changes.fresh], layout, recursive=False, **options)

    def done(self) -> None:
        if self.changes:
            self.ledger.commit(self.changes, self.ledger.new_run() if self.changes.fresh else None)


# --- run log ---------------------------------------------------------------------

RUN_LOG_SCHEMA = (
    "run_started_epoch BIGINT, fact STRING, input STRING, created BOOLEAN, watermark_before STRING, "
    "new_fact_rows BIGINT, rows_written BIGINT, table_rows BIGINT, watermark_after STRING"
)


def log_run(spark: SparkSession, log_table: str, report: RunReport, started_epoch: int,
            path: str | None = None, source: str | None = None) -> None:
    """Append one row describing a finished run, and the input it read, to a small run-log table.

    A log from before inputs were logged gets the column, NULL for its rows.
    """
    def iso(v):
        return v.isoformat(sep=" ") if v is not None else None

    row = [(started_epoch, report.table, source, report.created, iso(report.watermark_before),
            report.new_fact_rows, report.rows_written, report.table_rows, iso(report.watermark_after))]
    rows = spark.createDataFrame(row, RUN_LOG_SCHEMA)
    sinks.attach_if_present(spark, log_table, path)
    if sinks.table_exists(spark, log_table):
        sinks.sync_all_columns(spark, log_table, rows.schema)
    sinks.create_or_append(rows, log_table, path=path)


def last_run_started(
    spark: SparkSession, log_table: str, fact: str, path: str | None = None, fact_path: str | None = None,
    source: str | None = None,
) -> int | None:
    """Start time (epoch seconds) of the latest logged run into ``fact`` (from ``source``, if given), or None.

    None as well when the fact does not exist or has no watermark (dropped,
    emptied): its next run has to read every file again.
    """
    sinks.attach_if_present(spark, log_table, path)
    sinks.attach_if_present(spark, fact, fact_path)
    if not sinks.table_exists(spark, log_table) or not sinks.table_exists(spark, fact):
        return None
    if not spark.table(fact).where(F.col("date").isNotNull()).take(1):
        return None
    runs = spark.table(log_table).where(F.col("fact") == fact)
    if source is not None:
        # a run that read another input says nothing about this one's files
        runs = runs.where(F.col("input") == source) if "input" in runs.columns else runs.limit(0)
    return runs.agg(F.max("run_started_epoch")).first()[0]
