"""Golden telemetry fixtures: fan-out, bad keys, unmatched keys, watermark tie,
late rows, empty target, reruns and the daily-aggregate upsert."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from paddock.operators import models
from paddock.plans import ingest, sinks
from paddock.schemas import AVERAGE_SPEED_KEYS, AVG_SPEED_GEAR_KEYS, CAR_COLUMNS_A, DRIVER_COLUMNS, SESSION_COLUMNS
from paddock.sources import files

DRIVERS = [("1", "Max V", "Red"), ("44", "Lewis H", "Silver"), ("44", "Lewis H", "Silver"), ("abc", "Bad N", None)]
SESSIONS = [(100, "Monza", "Italy"), (200, "Suzuka", "Japan")]
BATCH1 = [
    (1, 300, 8, "2023-09-01 13:00:00.000", 100),
    (1, 310, 8, "2023-09-01 13:00:00.500", 100),
    (44, 290, 7, "2023-09-01 13:00:01.000", 100),
    (99, 250, 5, "2023-09-01 13:00:02.000", 100),
    (1, 200, 4, "2023-09-22 05:00:00.000", 300),
    (44, 280, 7, "2023-09-22 05:00:01.000", 200),
]
BATCH2 = [
    (1, 305, 8, "2023-09-22 05:00:01.000", 200),  # ties the watermark
    (44, 270, 6, "2023-09-22 05:00:02.000", 200),
    (1, 299, 8, "2023-09-21 05:00:00.000", 200),  # late
]


def _csv(header: list[str], rows: list[dict]) -> str:
    lines = [",".join(header)]
    for r in rows:
        lines.append(",".join("" if r.get(c) is None else str(r[c]) for c in header))
    return "\n".join(lines) + "\n"


def _car_rows(batch):
    return [
        dict(driver_number=d, rpm=10000, speed=s, n_gear=g, throttle=90, brake=0, drs=0,
             date=t, session_key=k, meeting_key=1)
        for d, s, g, t, k in batch
    ]


@pytest.fixture()
def raw(workdir):
    write_text(f"{workdir}/drivers.csv", _csv(DRIVER_COLUMNS, [
        dict(driver_number=n, full_name=f, team_name=t, broadcast_name=f.upper()) for n, f, t in DRIVERS
    ]))
    write_text(f"{workdir}/sessions.csv", _csv(SESSION_COLUMNS, [
        dict(session_key=k, location=loc, country_name=c, year="2023") for k, loc, c in SESSIONS
    ]))
    write_text(f"{workdir}/car_data/2023/09/batch1.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH1)))
    return workdir


def _dims(spark, root):
    return files.read_drivers(spark, f"{root}/drivers.csv"), files.read_sessions(spark, f"{root}/sessions.csv")


def _car(spark, root):
    return files.read_car_csv(spark, f"{root}/car_data", "A", recursive=True)


def _ts(text):
    return dt.datetime.fromisoformat(text)


def test_three_runs(spark, raw):
    drivers, sessions = _dims(spark, raw)
    name = f"golden_fact_{uuid.uuid4().hex[:8]}"
    path = f"{raw}/tables/{name}"

    r1 = ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, name, path=path)
    assert r1.created
    assert (r1.new_fact_rows, r1.rows_written, r1.table_rows) == (6, 6, 6)
    assert r1.watermark_after == _ts("2023-09-22 05:00:01")

    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    r2 = ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, name)
    assert not r2.created
    assert r2.watermark_before == _ts("2023-09-22 05:00:01")
    assert (r2.new_fact_rows, r2.rows_written, r2.table_rows) == (1, 2, 8)
    assert r2.watermark_after == _ts("2023-09-22 05:00:02")

    r3 = ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, name)
    assert (r3.new_fact_rows, r3.rows_written, r3.table_rows) == (0, 0, 8)
    assert r3.watermark_after == r2.watermark_after
    assert not r3.wrote

    got = sorted(
        (r.full_name, r.speed, r.location, r.year)
        for r in spark.table(name).collect()
    )
    assert got == sorted([
        ("Max V", 300, "Monza", 2023), ("Max V", 310, "Monza", 2023),
        ("Lewis H", 290, "Monza", 2023), ("Lewis H", 290, "Monza", 2023),
        ("Lewis H", 280, "Suzuka", 2023), ("Lewis H", 280, "Suzuka", 2023),
        ("Lewis H", 270, "Suzuka", 2023), ("Lewis H", 270, "Suzuka", 2023),
    ])


def test_empty_target_means_full_load(spark, raw):
    drivers, sessions = _dims(spark, raw)
    name = f"golden_empty_{uuid.uuid4().hex[:8]}"
    empty = ingest.enrich(_car(spark, raw), drivers, sessions, add_year=True).limit(0)
    sinks.create_table(empty, name, ["year", "location", "full_name"], path=f"{raw}/tables/{name}")
    r = ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, name)
    assert r.watermark_before is None
    assert (r.new_fact_rows, r.rows_written, r.table_rows) == (6, 6, 6)
    assert r.watermark_after == _ts("2023-09-22 05:00:01")


def test_driver_and_session_keys_option(spark, raw):
    drivers, sessions = _dims(spark, raw)
    from paddock.operators.enrich import enrich

    # Keyed on number + session: the driver file has no session keys, so no match.
    out = enrich(_car(spark, raw), drivers, sessions, driver_keys=("driver_number", "session_key"))
    assert out.count() == 0
    assert enrich(_car(spark, raw), drivers, sessions).count() == 6


def _avg(rows, with_gear=False):
    return sorted(
        (r.team_name, r.full_name, r.location, str(r.date)) + ((r.n_gear,) if with_gear else ()) + (r.average_speed,)
        for r in rows
    )


def test_daily_aggregates_upsert(spark, raw):
    drivers, sessions = _dims(spark, raw)
    fact = f"golden_fact_{uuid.uuid4().hex[:8]}"
    avg_t, gear_t = f"golden_avg_{uuid.uuid4().hex[:8]}", f"golden_gear_{uuid.uuid4().hex[:8]}"
    ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, fact, path=f"{raw}/tables/{fact}")
    ingest.refresh_daily_models(spark, fact, avg_t, gear_t,
                                  path_average_speed=f"{raw}/tables/{avg_t}",
                                  path_avg_speed_gear=f"{raw}/tables/{gear_t}")
    assert _avg(spark.table(avg_t).collect()) == [
        ("Red", "Max V", "Monza", "2023-09-01", 305.0),
        ("Silver", "Lewis H", "Monza", "2023-09-01", 290.0),
        ("Silver", "Lewis H", "Suzuka", "2023-09-22", 280.0),
    ]
    assert _avg(spark.table(gear_t).collect(), True) == [
        ("Red", "Max V", "Monza", "2023-09-01", 8, 305.0),
        ("Silver", "Lewis H", "Monza", "2023-09-01", 7, 290.0),
        ("Silver", "Lewis H", "Suzuka", "2023-09-22", 7, 280.0),
    ]

    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, fact)
    ingest.refresh_daily_models(spark, fact, avg_t, gear_t)
    assert _avg(spark.table(avg_t).collect()) == [
        ("Red", "Max V", "Monza", "2023-09-01", 305.0),
        ("Silver", "Lewis H", "Monza", "2023-09-01", 290.0),
        ("Silver", "Lewis H", "Suzuka", "2023-09-22", 275.0),
    ]
    assert _avg(spark.table(gear_t).collect(), True) == [
        ("Red", "Max V", "Monza", "2023-09-01", 8, 305.0),
        ("Silver", "Lewis H", "Monza", "2023-09-01", 7, 290.0),
        ("Silver", "Lewis H", "Suzuka", "2023-09-22", 6, 270.0),
        ("Silver", "Lewis H", "Suzuka", "2023-09-22", 7, 280.0),
    ]

    # Upserting the same source again changes nothing, and keys stay unique.
    before = _avg(spark.table(avg_t).collect())
    ingest.refresh_daily_models(spark, fact, avg_t, gear_t)
    assert _avg(spark.table(avg_t).collect()) == before
    for t, keys in ((avg_t, AVERAGE_SPEED_KEYS), (gear_t, AVG_SPEED_GEAR_KEYS)):
        df = spark.table(t)
        assert df.count() == df.select(*keys).distinct().count()

    # Recomputing only the touched day gives the same table.
    ingest.refresh_daily_models(spark, fact, avg_t, gear_t, since=dt.datetime(2023, 9, 22))
    assert _avg(spark.table(avg_t).collect()) == before


def test_upsert_rejects_duplicate_source_keys(spark):
    df = spark.createDataFrame(
        [("a", "x", "m", dt.date(2023, 1, 1), 1.0), ("a", "x", "m", dt.date(2023, 1, 1), 2.0)],
        "team_name string, full_name string, location string, date date, average_speed double",
    )
    with pytest.raises(ValueError):
        sinks.upsert(df, f"dup_{uuid.uuid4().hex[:8]}", AVERAGE_SPEED_KEYS)


def test_null_keys_never_match_by_default(spark, workdir):
    schema = "team_name string, full_name string, location string, date date, average_speed double"
    t = spark.createDataFrame([(None, "x", "m", dt.date(2023, 1, 1), 1.0)], schema)
    s = spark.createDataFrame([(None, "x", "m", dt.date(2023, 1, 1), 2.0)], schema)
    from paddock.operators.merge import upsert_rows

    assert upsert_rows(t, s, AVERAGE_SPEED_KEYS).count() == 2
    assert upsert_rows(t, s, AVERAGE_SPEED_KEYS, null_safe=True).count() == 1


def test_sql_watermark_on_empty_target_keeps_nothing(spark):
    from paddock.operators import incremental

    src = spark.createDataFrame([(1,), (2,)], "id int")
    empty = src.limit(0)
    src.createOrReplaceTempView("wm_src")
    empty.createOrReplaceTempView("wm_empty")
    # SQL form keeps the model's behaviour; the DataFrame form loads everything.
    assert incremental.newer_than_sql(spark, "wm_src", "wm_empty", "id").count() == 0
    assert incremental.newer_than(src, empty, "id").count() == 2
    assert incremental.newer_than(src, src.where(F.col("id") == 1), "id").count() == 1


def test_run_daily_incremental_models_equal_full_recompute(spark, raw):
    import contextlib
    import io

    drivers, sessions = _dims(spark, raw)
    u = uuid.uuid4().hex[:8]
    t = ingest.DailyTables(
        fact=f"daily_fact_{u}", average_speed=f"daily_avg_{u}", avg_speed_gear=f"daily_gear_{u}",
        fact_path=f"{raw}/tables/fact_{u}", average_speed_path=f"{raw}/tables/avg_{u}",
        avg_speed_gear_path=f"{raw}/tables/gear_{u}",
    )
    r1 = ingest.run_daily(spark, _car(spark, raw), drivers, sessions, t)
    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    r2 = ingest.run_daily(spark, _car(spark, raw), drivers, sessions, t)
    assert (r1.rows_written, r2.rows_written) == (6, 2)
    assert _avg(spark.table(t.average_speed).collect()) == [
        ("Red", "Max V", "Monza", "2023-09-01", 305.0),
        ("Silver", "Lewis H", "Monza", "2023-09-01", 290.0),
        ("Silver", "Lewis H", "Suzuka", "2023-09-22", 275.0),
    ]
    full = models.avg_speed_gear(spark.table(t.fact))
    assert _avg(spark.table(t.avg_speed_gear).collect(), True) == _avg(full.collect(), True)
    # A run with nothing new leaves both tables as they are.
    r3 = ingest.run_daily(spark, _car(spark, raw), drivers, sessions, t)
    assert r3.rows_written == 0
    assert _avg(spark.table(t.average_speed).collect())[-1][-1] == 275.0

    # The day bound reaches the fact scan: year partitions pruned, date pushed.
    fact = spark.table(t.fact)
    since = r2.watermark_before
    q = fact.where((F.col("date") >= F.lit(since.date().isoformat()).cast("timestamp"))
                   & (F.col("year") >= since.year))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    assert "PartitionFilters: [isnotnull(year" in buf.getvalue()
    assert "GreaterThanOrEqual(date," in buf.getvalue()


def test_second_job_layout_b_glob_no_year(spark, raw):
    """Layout B files read through a one-level glob, no year column, and the
    table partitioned by team and driver."""
    from paddock.schemas import CAR_COLUMNS_B

    write_text(f"{raw}/car_b/batch1.csv", _csv(CAR_COLUMNS_B, _car_rows(BATCH1)))
    drivers, sessions = _dims(spark, raw)
    car = files.read_car_csv(spark, f"{raw}/car_b/*.csv", "B", recursive=False)
    name = f"golden_b_{uuid.uuid4().hex[:8]}"
    r = ingest.run_ingest(spark, car, drivers, sessions, name, add_year=False,
                            partition_cols=("team_name", "full_name"), path=f"{raw}/tables/{name}")
    assert (r.new_fact_rows, r.rows_written) == (6, 6)
    t = spark.table(name)
    assert "year" not in t.columns
    assert sinks.partition_columns(spark, name) == ["team_name", "full_name"]
    assert sorted(r.speed for r in t.collect()) == [280, 280, 290, 290, 300, 310]


def test_daily_job_command_line(raw):
    """The submit entry point runs twice in its own process and reports JSON."""
    import json
    import subprocess
    import sys

    from conftest import REPO

    args = [
        sys.executable, str(REPO / "paddock" / "plans" / "daily_job.py"),
        "--car", f"{raw}/car_data", "--recursive",
        "--drivers", f"{raw}/drivers.csv", "--sessions", f"{raw}/sessions.csv",
        "--fact", "cli_fact", "--fact-path", f"{raw}/tables/cli_fact",
        "--partition-by", "year,location", "--profile", "local",
    ]
    # One process per run, like a daily submit; the table lives at its path.
    first = subprocess.run(args, capture_output=True, text=True, timeout=300)
    assert first.returncode == 0, first.stderr[-3000:]
    rep = json.loads(first.stdout.strip().splitlines()[-1])
    assert (rep["created"], rep["rows_written"], rep["table_rows"]) == (True, 6, 6)
    assert rep["watermark_after"] == "2023-09-22T05:00:01"

    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    second = subprocess.run(args, capture_output=True, text=True, timeout=300)
    assert second.returncode == 0, second.stderr[-3000:]
    rep = json.loads(second.stdout.strip().splitlines()[-1])
    # A new process: the table is found at its location and only c8 is new.
    assert (rep["created"], rep["new_fact_rows"], rep["rows_written"], rep["table_rows"]) == (False, 1, 2, 8)
    assert rep["watermark_before"] == "2023-09-22T05:00:01"


def test_schema_sync_on_ingest_and_upsert(spark, raw):
    """A run whose rows gain a column syncs the table first (old rows NULL)."""
    drivers, sessions = _dims(spark, raw)
    name = f"sync_{uuid.uuid4().hex[:8]}"
    ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, name, add_year=False,
                      partition_cols=("team_name",), path=f"{raw}/tables/{name}")
    assert "year" not in spark.table(name).columns
    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    r = ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, name, add_year=True,
                          partition_cols=("team_name",), on_schema_change="sync_all_columns")
    assert r.rows_written == 2
    t = spark.table(name)
    assert "year" in t.columns and sinks.partition_columns(spark, name) == ["team_name"]
    years = sorted((r.year is None) for r in t.collect())
    assert years.count(True) == 6 and years.count(False) == 2

    # Upsert: the source lost a column and retyped another.
    schema = "team_name string, full_name string, location string, date date, average_speed double, n int"
    a = f"sync_avg_{uuid.uuid4().hex[:8]}"
    sinks.upsert(spark.createDataFrame([("T", "D", "L", dt.date(2024, 1, 1), 1.0, 5)], schema), a,
                 AVERAGE_SPEED_KEYS, path=f"{raw}/tables/{a}")
    new = spark.createDataFrame([("T", "D", "L", dt.date(2024, 1, 2), 2)],
                                "team_name string, full_name string, location string, date date, average_speed int")
    sinks.upsert(new, a, AVERAGE_SPEED_KEYS, on_schema_change="sync_all_columns")
    t = spark.table(a)
    assert "n" not in t.columns and dict(t.dtypes)["average_speed"] == "int"
    assert sorted((str(r.date), r.average_speed) for r in t.collect()) == [("2024-01-01", 1), ("2024-01-02", 2)]


def test_telemetry_model_chain_golden(spark, raw):
    from paddock.plans.telemetry_models import (
        AVERAGE_SPEED, FACT_COPY, TelemetryModelNames, build_telemetry_models,
    )

    drivers, sessions = _dims(spark, raw)
    u = uuid.uuid4().hex[:8]
    src = f"chain_src_{u}"
    names = TelemetryModelNames(prefix=f"chain_{u}_", path_root=f"{raw}/tables/chain_{u}")
    ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, src, path=f"{raw}/tables/{src}")
    assert build_telemetry_models(spark, src, names) == 6
    assert _avg(spark.table(names.table(AVERAGE_SPEED)).collect())[-1] == \
        ("Silver", "Lewis H", "Suzuka", "2023-09-22", 280.0)
    assert sinks.partition_columns(spark, names.table(FACT_COPY)) == ["team_name", "full_name"]

    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, src)
    assert build_telemetry_models(spark, src, names) == 2
    assert build_telemetry_models(spark, src, names) == 0  # nothing new, nothing changes
    assert _avg(spark.table(names.table(AVERAGE_SPEED)).collect()) == [
        ("Red", "Max V", "Monza", "2023-09-01", 305.0),
        ("Silver", "Lewis H", "Monza", "2023-09-01", 290.0),
        ("Silver", "Lewis H", "Suzuka", "2023-09-22", 275.0),
    ]


def test_added_columns_only_change_metadata(spark, workdir):
    """Adding a column keeps every existing data file untouched."""
    import os

    from pyspark.sql.types import StructType

    name = f"addcol_{uuid.uuid4().hex[:8]}"
    path = f"{workdir}/{name}"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, p string")
    sinks.create_table(df, name, ["p"], path=path)
    files_before = {os.path.join(r, f): os.path.getmtime(os.path.join(r, f))
                    for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    new = StructType.fromDDL("id bigint, extra string, p string")
    change = sinks.sync_all_columns(spark, name, new)
    assert change.added == ["extra"] and not change.removed and not change.retyped
    files_after = {os.path.join(r, f): os.path.getmtime(os.path.join(r, f))
                   for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert files_after == files_before
    sinks.append(spark.createDataFrame([(3, "x", "c")], "id bigint, extra string, p string"), name)
    got = sorted((r.id, r.extra, r.p) for r in spark.table(name).collect())
    assert got == [(1, None, "a"), (2, None, "b"), (3, "x", "c")]


def test_daily_job_auto_reads_only_files_since_the_last_run(raw):
    import json
    import os
    import subprocess
    import sys
    import time

    from conftest import REPO

    args = [
        sys.executable, str(REPO / "paddock" / "plans" / "daily_job.py"),
        "--car", f"{raw}/car_data", "--recursive",
        "--drivers", f"{raw}/drivers.csv", "--sessions", f"{raw}/sessions.csv",
        "--fact", "auto_fact", "--fact-path", f"{raw}/tables/auto_fact",
        "--partition-by", "year,location", "--profile", "local",
        "--files-modified-after", "auto", "--modified-margin", "60",
    ]
    first = subprocess.run(args, capture_output=True, text=True, timeout=300)
    assert first.returncode == 0, first.stderr[-3000:]
    rep = json.loads(first.stdout.strip().splitlines()[-1])
    assert rep["files_modified_after"] is None and rep["rows_written"] == 6

    # An old raw file that a full re-read would pick up again (a row newer than
    # the watermark was slipped into it), back-dated; and a genuinely new file.
    old = f"{raw}/car_data/2023/09/batch1.csv"
    sneaky = BATCH1 + [(1, 333, 8, "2023-09-23 05:00:00.000", 200)]
    write_text(old, _csv(CAR_COLUMNS_A, _car_rows(sneaky)))
    past = time.time() - 2 * 86400
    os.utime(old, (past, past))
    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))

    second = subprocess.run(args, capture_output=True, text=True, timeout=300)
    assert second.returncode == 0, second.stderr[-3000:]
    rep = json.loads(second.stdout.strip().splitlines()[-1])
    assert rep["files_modified_after"] is not None
    # Only the new file was parsed: c8 loads (2 rows), the back-dated row does not.
    assert (rep["new_fact_rows"], rep["rows_written"], rep["table_rows"]) == (1, 2, 8)


def _daily(spark, raw, tag, **models):
    """A run of the daily job's steps over the raw files; returns (report, tables)."""
    drivers, sessions = _dims(spark, raw)
    root = f"{raw}/tables"
    tables = ingest.DailyTables(f"{tag}_fact", f"{tag}_avg", f"{tag}_gear", f"{root}/{tag}_fact", f"{root}/{tag}_avg", f"{root}/{tag}_gear")
    return ingest.run_daily(spark, _car(spark, raw), drivers, sessions, tables, **models), tables


def _equals_full_recompute(spark, tables):
    from paddock.operators import models

    fact = spark.table(tables.fact)
    for table, model in ((tables.average_speed, models.average_speed), (tables.avg_speed_gear, models.avg_speed_gear)):
        want = model(fact)
        got = spark.table(table).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_daily_models_after_a_crash_between_fact_and_models(spark, raw):
    tag = f"crash_{uuid.uuid4().hex[:8]}"
    _, tables = _daily(spark, raw, tag)
    _equals_full_recompute(spark, tables)
    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    drivers, sessions = _dims(spark, raw)
    ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, tables.fact, path=tables.fact_path)  # and dies here
    report, _ = _daily(spark, raw, tag)
    assert not report.wrote
    _equals_full_recompute(spark, tables)
    assert not ingest.refresh_stale_models(spark, tables.fact, tables.average_speed, tables.avg_speed_gear, report.token_after)


def test_daily_models_added_after_the_fact(spark, raw):
    tag = f"later_{uuid.uuid4().hex[:8]}"
    drivers, sessions = _dims(spark, raw)
    ingest.run_ingest(spark, _car(spark, raw), drivers, sessions, f"{tag}_fact", path=f"{raw}/tables/{tag}_fact")
    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    _, tables = _daily(spark, raw, tag)
    _equals_full_recompute(spark, tables)


def test_columns_that_a_table_lacks_are_refused(spark, raw):
    name = f"extra_{uuid.uuid4().hex[:8]}"
    sinks.create_table(spark.createDataFrame([(1,)], "a int"), name, path=f"{raw}/tables/{name}")
    more = spark.createDataFrame([(2, 3)], "a int, b int")
    with pytest.raises(ValueError, match="no columns"):
        sinks.append(more, name)
    sinks.append(more, name, ignore_extra=True)
    assert spark.table(name).count() == 2


def test_refresh_under_dynamic_overwrite_leaves_no_old_rows(spark, raw):
    name = f"full_{uuid.uuid4().hex[:8]}"
    both = spark.createDataFrame([("x", 1), ("y", 2)], "p string, v int")
    sinks.create_table(both, name, ["p"], path=f"{raw}/tables/{name}")
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        sinks.refresh(both.where("p = 'x'"), name, ["p"])
        assert spark.conf.get(key) == "dynamic"
    finally:
        spark.conf.unset(key)
    assert [tuple(r) for r in spark.table(name).select("p", "v").collect()] == [("x", 1)]


def test_the_run_log_of_another_fact_skips_no_file(spark, raw):
    tag = f"log_{uuid.uuid4().hex[:8]}"
    report, tables = _daily(spark, raw, tag)
    log = f"{tag}_runs"
    ingest.log_run(spark, log, report, 1_700_000_000, f"{raw}/tables/{log}")
    assert ingest.last_run_started(spark, log, tables.fact) == 1_700_000_000
    assert ingest.last_run_started(spark, log, f"{tag}_other") is None


def test_two_decimals_nulls_in_maps_and_routes(spark):
    from paddock.functions import scalars

    values = [1.005, 2.675, 0.125, 1236.7, 1234567.891, 0.0]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.t for r in got.orderBy("i").select(scalars.total_report("v").alias("t")).collect()]
    assert got == [f"Total order value is: {v:.2f}" for v in values]
    one = spark.createDataFrame([('{"a": 1, "b": null}', None)], "j string, ts timestamp")
    assert one.select(scalars.map_values_sum(scalars.json_number_map("j")).alias("s")).first().s == 1.0
    assert scalars.weekday_route(one, "ts").first().route is None
