"""End-to-end runs: CSV ingest, stream ingest, run report, namespaces, daily job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from paddock.plans import ingest, sinks, standins
from paddock.plans.file_ledger import listing
from paddock.plans.queries.base import (
    FACT_PARTITIONS, LOADED_BEFORE, enriched_fact, register, scratch_table, ts_ntz,
)
from paddock.plans.queries.oracle import (
    SQL_AVG, SQL_AVG_GEAR, SQL_ENRICHED, SQL_ENRICHED_YEAR, SQL_INGEST_REPORT,
)
from paddock.plans.standins import StandIns
from paddock.schemas import CAR_COLUMNS_A, CAR_COLUMNS_B
from paddock.session import scratch_path, unique_table_name
from paddock.sources import files, tables
from paddock.streaming import file_ingest


# --- end-to-end: raw CSV files -> watermark -> star join -> partitioned table --------------------

def _raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Export the stand-ins as raw CSV: car rows in two arrivals, and the dims."""
    s = StandIns(spark, sf_dir)
    root = scratch_path(spark, "raw")
    car = s.car().withColumn("day", F.date_format("date", "yyyy-MM-dd"))
    files.write_csv(s.drivers(), f"{root}/drivers")
    files.write_csv(s.sessions(), f"{root}/sessions")
    files.write_csv(
        car.where(F.col("date") < ts_ntz(LOADED_BEFORE)),
        f"{root}/car_data/arrival=1", columns=CAR_COLUMNS_A, nest_by="day",
    )
    return root


def _second_arrival(spark: SparkSession, sf_dir: str, root: str) -> None:
    car = StandIns(spark, sf_dir).car().withColumn("day", F.date_format("date", "yyyy-MM-dd"))
    files.write_csv(
        car.where(F.col("date") >= ts_ntz(LOADED_BEFORE)),
        f"{root}/car_data/arrival=2", columns=CAR_COLUMNS_A, nest_by="day",
    )


def _raw_dims(spark: SparkSession, root: str):
    drivers = files.read_drivers(spark, f"{root}/drivers")
    sessions = files.read_sessions(
        spark, f"{root}/sessions", ts_type=TimestampNTZType(), timestamp_ntz_format=files.TS_NTZ_FORMAT
    )
    return drivers, sessions


def _raw_car(spark: SparkSession, root: str) -> DataFrame:
    return files.read_car_csv(
        spark, f"{root}/car_data", "A", recursive=True, ts_type=TimestampNTZType(),
        timestamp_ntz_format=files.TS_NTZ_FORMAT,
    )


@register("ingest_csv_runs", SQL_ENRICHED_YEAR)
def q_ingest_csv_runs(spark, sf_dir):
    root = _raw_files(spark, sf_dir)
    drivers, sessions = _raw_dims(spark, root)
    name, path = scratch_table(spark, "car_telemetry")
    ingest.run_ingest(spark, _raw_car(spark, root), drivers, sessions, name,
                        partition_cols=FACT_PARTITIONS, path=path)
    _second_arrival(spark, sf_dir, root)
    ingest.run_ingest(spark, _raw_car(spark, root), drivers, sessions, name,
                        partition_cols=FACT_PARTITIONS, path=path)
    return spark.table(name)


@register("stream_ingest", SQL_ENRICHED_YEAR)
def q_stream_ingest(spark, sf_dir):
    root = _raw_files(spark, sf_dir)
    drivers, sessions = _raw_dims(spark, root)
    out, ckpt = f"{root}/fact_stream", f"{root}/fact_stream_checkpoint"
    stream = file_ingest.car_stream(
        spark, f"{root}/car_data", "A", ts_type=TimestampNTZType(),
        timestampNTZFormat=files.TS_NTZ_FORMAT,
    )
    file_ingest.run_file_ingest_once(spark, stream, drivers, sessions, out, ckpt,
                                     partition_cols=FACT_PARTITIONS)
    _second_arrival(spark, sf_dir, root)
    stream = file_ingest.car_stream(
        spark, f"{root}/car_data", "A", ts_type=TimestampNTZType(),
        timestampNTZFormat=files.TS_NTZ_FORMAT,
    )
    file_ingest.run_file_ingest_once(spark, stream, drivers, sessions, out, ckpt,
                                     partition_cols=FACT_PARTITIONS)
    return file_ingest.read_output(spark, out, file_ingest.enriched_schema(stream, drivers, sessions))


# --- run report and catalog namespaces ---------------------------------------------------------


@register("ingest_report", SQL_INGEST_REPORT)
def q_ingest_report(spark, sf_dir):
    """Two runs of the ingest over the stand-in car frame; one report row each."""
    s = StandIns(spark, sf_dir)
    car, drivers, sessions = s.car(), s.drivers(), s.sessions()
    name, path = scratch_table(spark, "fact_report")
    r1 = ingest.run_ingest(spark, car.where(F.col("date") < ts_ntz(LOADED_BEFORE)), drivers, sessions,
                             name, partition_cols=FACT_PARTITIONS, path=path)
    r2 = ingest.run_ingest(spark, car, drivers, sessions, name, partition_cols=FACT_PARTITIONS)
    rows = [
        (i, r.created, r.watermark_before, r.new_fact_rows, r.rows_written, r.table_rows, r.watermark_after)
        for i, r in ((1, r1), (2, r2))
    ]
    return spark.createDataFrame(
        rows,
        "run int, created boolean, watermark_before timestamp_ntz, new_fact_rows bigint, "
        "rows_written bigint, table_rows bigint, watermark_after timestamp_ntz",
    )


SQL_GATED_REPORT = SQL_INGEST_REPORT + """
UNION ALL
SELECT 3, FALSE, wm, 0, 0, (SELECT rows_written FROM r1) + rows_written, wm
FROM r2"""


@register("ingest_report_gate", SQL_GATED_REPORT)
def q_ingest_report_gate(spark, sf_dir):
    """Three runs; the third finds no new row and leaves the table's files and definition as they are."""
    s = StandIns(spark, sf_dir)
    car, drivers, sessions = s.car(), s.drivers(), s.sessions()
    name, path = scratch_table(spark, "fact_gate")
    reports = [ingest.run_ingest(spark, car.where(F.col("date") < ts_ntz(LOADED_BEFORE)), drivers, sessions, name,
                                 partition_cols=FACT_PARTITIONS, path=path)]
    reports.append(ingest.run_ingest(spark, car, drivers, sessions, name))

    def table_now():
        return listing(spark, path).collect(), spark.table(name).inputFiles(), spark.table(name).schema

    before = table_now()
    reports.append(ingest.run_ingest(spark, car, drivers, sessions, name, on_schema_change="sync_all_columns"))
    assert table_now() == before
    return spark.createDataFrame(
        [(i, r.created, r.watermark_before, r.new_fact_rows, r.rows_written, r.table_rows, r.watermark_after) for i, r in enumerate(reports, 1)],
        "run int, created boolean, watermark_before timestamp_ntz, new_fact_rows bigint, "
        "rows_written bigint, table_rows bigint, watermark_after timestamp_ntz",
    )


@register("ingest_new_files", SQL_ENRICHED_YEAR)
def q_ingest_new_files(spark, sf_dir):
    """Two arrivals through the ledger of raw files, then a run that finds none; each file is parsed once."""
    root = _raw_files(spark, sf_dir)
    drivers, sessions = _raw_dims(spark, root)
    name, path = scratch_table(spark, "fact_files")
    read = []
    for arrival in (1, 2, 3):
        if arrival == 2:
            _second_arrival(spark, sf_dir, root)
        taken = ingest.NewCarFiles(spark, f"{path}_input", name, path)
        car = taken.read(f"{root}/car_data", "A", ts_type=TimestampNTZType(), timestamp_ntz_format=files.TS_NTZ_FORMAT)
        ingest.run_ingest(spark, car, drivers, sessions, name, partition_cols=FACT_PARTITIONS, path=path)
        taken.done()
        read += taken.changes.fresh
    assert sorted(read) == sorted(r["file"] for r in listing(spark, f"{root}/car_data").collect())
    return spark.table(name)


# Raw rows of which some have a speed that is no number, some a date that is none.
_BAD_SPEED, _BAD_DATE = "event_id % 97 = 0", "event_id % 89 = 0"
_LINE = " || ',' || ".join(
    {"driver_number": "CAST(user_id AS VARCHAR)", "speed": f"CASE WHEN {_BAD_SPEED} THEN 'fast' ELSE CAST(CAST(FLOOR(value) AS INTEGER) AS VARCHAR) END",
     "n_gear": "CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 9 AS VARCHAR)", "session_key": "CAST(user_id % 25 AS VARCHAR)",
     "date": f"CASE WHEN {_BAD_DATE} THEN 'noon' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END"}.get(c, "''")
    for c in CAR_COLUMNS_A
)


@register("quarantine_bad_lines", f"""
SELECT line, 5 - CAST(bad_speed AS INTEGER) - CAST(bad_date AS INTEGER) - CAST(gearless AS INTEGER) AS fields, COUNT(DISTINCT part) AS files
FROM (SELECT {_LINE} AS line, {_BAD_SPEED} AS bad_speed, {_BAD_DATE} AS bad_date, event_id % 3 AS part,
             json_extract_string(props, '$.k') IS NULL AS gearless FROM events)
WHERE bad_speed OR bad_date GROUP BY ALL""")
def q_quarantine_bad_lines(spark, sf_dir):
    """Lines of an exported tree with fields that can't be parsed, set aside by a run and its repetition, each once."""
    s = StandIns(spark, sf_dir)
    root = scratch_path(spark, "raw_bad")
    car = standins.car_from_events(s.t("events"), keep=["event_id"])
    car = car.withColumns({
        "speed": F.when(F.expr(_BAD_SPEED), "fast").otherwise(F.col("speed").cast("string")),
        "date": F.when(F.expr(_BAD_DATE), "noon").otherwise(F.date_format("date", files.TS_NTZ_FORMAT)),
        "part": F.col("event_id") % 3,
    })
    files.write_csv(car, f"{root}/car_data", columns=CAR_COLUMNS_A, nest_by="part")
    (name, path), (bad, bad_path) = scratch_table(spark, "fact_bad"), scratch_table(spark, "bad_lines")
    for _ in range(2):
        raw = files.read_car_csv(spark, f"{root}/car_data", "A", ts_type=TimestampNTZType(), timestamp_ntz_format=files.TS_NTZ_FORMAT, bad_lines=True)
        ingest.run_ingest(spark, raw, s.drivers(), s.sessions(), name, partition_cols=FACT_PARTITIONS, path=path, bad_lines=bad, bad_lines_path=bad_path)
    return spark.table(bad).groupBy("line", "fields").agg(F.count(F.lit(1)).alias("files"))


@register("table_in_database", SQL_ENRICHED_YEAR)
def q_table_in_database(spark, sf_dir):
    """Create a namespace at a scratch location, then a managed table in it,
    addressed by a three-part name."""
    db = unique_table_name("paddock_db")
    tables.ensure_database(spark, db, scratch_path(spark, "db"))
    name = f"spark_catalog.{db}.car_telemetry"
    created = sinks.create_or_append(enriched_fact(spark, sf_dir, add_year=True), name, FACT_PARTITIONS)
    assert created and sinks.table_exists(spark, name)
    return tables.read_table(spark, name)


def _daily_scenario(spark: SparkSession, sf_dir: str, stem: str) -> ingest.DailyTables:
    """Two scheduled runs: the rows before the cut-off, then all rows."""
    s = StandIns(spark, sf_dir)
    car, drivers, sessions = s.car(), s.drivers(), s.sessions()
    names = {k: scratch_table(spark, f"{stem}_{k}") for k in ("fact", "avg", "gear")}
    t = ingest.DailyTables(
        fact=names["fact"][0], average_speed=names["avg"][0], avg_speed_gear=names["gear"][0],
        fact_path=names["fact"][1], average_speed_path=names["avg"][1], avg_speed_gear_path=names["gear"][1],
    )
    ingest.run_daily(spark, car.where(F.col("date") < ts_ntz(LOADED_BEFORE)), drivers, sessions, t,
                       partition_cols=FACT_PARTITIONS)
    ingest.run_daily(spark, car, drivers, sessions, t, partition_cols=FACT_PARTITIONS)
    return t


@register("daily_average_speed", f"WITH {SQL_ENRICHED} {SQL_AVG.format(src='enriched')}")
def q_daily_average_speed(spark, sf_dir):
    """The incremental daily job's average_speed table equals a full recompute."""
    return spark.table(_daily_scenario(spark, sf_dir, "daily").average_speed)


@register("daily_avg_speed_gear", f"WITH {SQL_ENRICHED} {SQL_AVG_GEAR.format(src='enriched')}")
def q_daily_avg_speed_gear(spark, sf_dir):
    return spark.table(_daily_scenario(spark, sf_dir, "daily").avg_speed_gear)


def _new_tables(spark: SparkSession, stem: str) -> ingest.DailyTables:
    names = {k: scratch_table(spark, f"{stem}_{k}") for k in ("fact", "avg", "gear")}
    return ingest.DailyTables(
        fact=names["fact"][0], average_speed=names["avg"][0], avg_speed_gear=names["gear"][0],
        fact_path=names["fact"][1], average_speed_path=names["avg"][1], avg_speed_gear_path=names["gear"][1],
    )


@register("daily_after_crash", f"WITH {SQL_ENRICHED} {SQL_AVG.format(src='enriched')}")
def q_daily_after_crash(spark, sf_dir):
    """A run that commits the fact over several days and dies before its aggregates; the next one makes it good."""
    s = StandIns(spark, sf_dir)
    car, drivers, sessions = s.car(), s.drivers(), s.sessions()
    t = _new_tables(spark, "crash")
    ingest.run_daily(spark, car.where(F.col("date") < ts_ntz(LOADED_BEFORE)), drivers, sessions, t, partition_cols=FACT_PARTITIONS)
    ingest.run_ingest(spark, car, drivers, sessions, t.fact, partition_cols=FACT_PARTITIONS, path=t.fact_path)
    ingest.run_daily(spark, car, drivers, sessions, t, partition_cols=FACT_PARTITIONS)
    return spark.table(t.average_speed)


@register("daily_models_added_later", f"WITH {SQL_ENRICHED} {SQL_AVG_GEAR.format(src='enriched')}")
def q_daily_models_added_later(spark, sf_dir):
    """A fact that was loaded before its aggregates existed."""
    s = StandIns(spark, sf_dir)
    car, drivers, sessions = s.car(), s.drivers(), s.sessions()
    t = _new_tables(spark, "later")
    ingest.run_ingest(spark, car.where(F.col("date") < ts_ntz(LOADED_BEFORE)), drivers, sessions, t.fact,
                      partition_cols=FACT_PARTITIONS, path=t.fact_path)
    ingest.run_daily(spark, car, drivers, sessions, t, partition_cols=FACT_PARTITIONS)
    return spark.table(t.avg_speed_gear)


@register("daily_late_rows", f"WITH {SQL_ENRICHED} {SQL_AVG_GEAR.format(src='enriched')}")
def q_daily_late_rows(spark, sf_dir):
    """Rows from below the watermark reach the fact (a repair by hand); the next run's aggregates hold them."""
    s = StandIns(spark, sf_dir)
    car, drivers, sessions = s.car(), s.drivers(), s.sessions()
    t = _new_tables(spark, "late")
    late = F.col("date") < ts_ntz(LOADED_BEFORE)
    ingest.run_daily(spark, car.where(~late), drivers, sessions, t, partition_cols=FACT_PARTITIONS)
    sinks.append(enriched_fact(spark, sf_dir, add_year=True).where(late), t.fact)
    report = ingest.run_daily(spark, car, drivers, sessions, t, partition_cols=FACT_PARTITIONS)
    assert not report.wrote  # the watermark shows nothing of it
    return spark.table(t.avg_speed_gear)


@register(
    "daily_fact_rebuilt",
    f"""WITH {SQL_ENRICHED},
rebuilt AS (SELECT team_name, full_name, location, "date", speed + 7 AS speed FROM enriched WHERE speed % 5 <> 0)
{SQL_AVG.format(src='rebuilt')}""",
)
def q_daily_fact_rebuilt(spark, sf_dir):
    """The fact is built anew with other speeds, fewer rows and the same last date; its aggregates follow."""
    t = _daily_scenario(spark, sf_dir, "rebuilt")
    rebuilt = enriched_fact(spark, sf_dir, add_year=True).where("speed % 5 <> 0").withColumn("speed", F.col("speed") + 7)
    sinks.refresh(rebuilt, t.fact, FACT_PARTITIONS)
    ingest.refresh_stale_models(spark, t.fact, t.average_speed, t.avg_speed_gear)
    return spark.table(t.average_speed)


@register("daily_forced_refresh", f"WITH {SQL_ENRICHED} {SQL_AVG.format(src='enriched')}")
def q_daily_forced_refresh(spark, sf_dir):
    """Every day is recomputed from the whole fact on demand, whatever the aggregates and their state hold."""
    t = _daily_scenario(spark, sf_dir, "forced")
    state = f"{sinks.table_location(spark, t.fact)}_speed_state/partials"
    spark.read.parquet(state).limit(0).drop("run").write.mode("overwrite").parquet(state)  # the state is lost
    assert ingest.refresh_stale_models(spark, t.fact, t.average_speed, t.avg_speed_gear, incremental=False)
    return spark.table(t.average_speed)


@register("ingest_layout_b", f"WITH {SQL_ENRICHED} SELECT * FROM enriched")
def q_ingest_layout_b(spark, sf_dir):
    """The second job's flavour: alphabetical (B) car files read through a
    one-level glob, no year column, table partitioned by team (the reference
    adds the driver name, one folder per driver)."""
    s = StandIns(spark, sf_dir)
    root = scratch_path(spark, "raw_b")
    files.write_csv(s.car(), f"{root}/car_data", columns=CAR_COLUMNS_B)
    drivers, sessions = s.drivers(), s.sessions()
    car = files.read_car_csv(spark, f"{root}/car_data/*.csv", "B", recursive=False,
                             ts_type=TimestampNTZType(), timestamp_ntz_format=files.TS_NTZ_FORMAT)
    name, path = scratch_table(spark, "fact_b")
    ingest.run_ingest(spark, car, drivers, sessions, name, partition_cols=("team_name",),
                      add_year=False, path=path)
    return spark.table(name)


def _telemetry_chain(spark: SparkSession, sf_dir: str):
    """The ingest output grows by two loads; the model chain runs after each."""
    from paddock.plans.telemetry_models import TelemetryModelNames, build_telemetry_models

    e = enriched_fact(spark, sf_dir, add_year=True)
    source, source_path = scratch_table(spark, "chain_source")
    tag, root = scratch_table(spark, "chain")
    names = TelemetryModelNames(prefix=f"{tag}_", path_root=root)
    sinks.create_table(e.where(F.col("date") < ts_ntz(LOADED_BEFORE)), source, FACT_PARTITIONS, path=source_path)
    # The stand-in has one "driver" per customer: partition the copy by team
    # only (the reference adds the driver name).
    build_telemetry_models(spark, source, names, copy_partitions=("team_name",))
    sinks.append(e.where(F.col("date") >= ts_ntz(LOADED_BEFORE)), source)
    build_telemetry_models(spark, source, names, copy_partitions=("team_name",))
    return names


@register("telemetry_models_average_speed", f"WITH {SQL_ENRICHED} {SQL_AVG.format(src='enriched')}")
def q_telemetry_models_average_speed(spark, sf_dir):
    from paddock.plans.telemetry_models import AVERAGE_SPEED

    return spark.table(_telemetry_chain(spark, sf_dir).table(AVERAGE_SPEED))


@register("telemetry_models_avg_speed_gear", f"WITH {SQL_ENRICHED} {SQL_AVG_GEAR.format(src='enriched')}")
def q_telemetry_models_avg_speed_gear(spark, sf_dir):
    from paddock.plans.telemetry_models import AVG_SPEED_GEAR

    return spark.table(_telemetry_chain(spark, sf_dir).table(AVG_SPEED_GEAR))


@register(
    "telemetry_models_schema_sync",
    f"""WITH {SQL_ENRICHED}
SELECT full_name, team_name, rpm, CAST(speed AS BIGINT) AS speed, n_gear, brake, drs, "date", location,
       CASE WHEN "date" >= TIMESTAMP '{LOADED_BEFORE}' THEN country_name END AS country_name, CAST(year("date") AS INTEGER) AS year
FROM enriched""",
)
def q_telemetry_models_schema_sync(spark, sf_dir):
    """The source changes its columns between two runs (one comes, one goes, one is widened); the copy follows."""
    from paddock.plans.telemetry_models import FACT_COPY, TelemetryModelNames, build_telemetry_models

    e = enriched_fact(spark, sf_dir, add_year=True)
    source, source_path = scratch_table(spark, "sync_source")
    tag, root = scratch_table(spark, "sync")
    names = TelemetryModelNames(prefix=f"{tag}_", path_root=root)
    old = e.where(F.col("date") < ts_ntz(LOADED_BEFORE)).drop("country_name").withColumn("note", F.lit("old"))
    sinks.create_table(old, source, FACT_PARTITIONS, path=source_path)
    build_telemetry_models(spark, source, names, copy_partitions=("team_name",))
    sinks.refresh(e.withColumn("speed", F.col("speed").cast("long")), source, FACT_PARTITIONS)
    build_telemetry_models(spark, source, names, copy_partitions=("team_name",))
    return spark.table(names.table(FACT_COPY))


@register("telemetry_models_copy", SQL_ENRICHED_YEAR)
def q_telemetry_models_copy(spark, sf_dir):
    from paddock.plans.telemetry_models import FACT_COPY

    return spark.table(_telemetry_chain(spark, sf_dir).table(FACT_COPY))
