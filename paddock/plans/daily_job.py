"""Command-line entry for the scheduled run (submit with ``spark-submit``).

    spark-submit paddock/plans/daily_job.py \\
        --car s3a://lake/raw/car_data --layout A --recursive \\
        --drivers s3a://lake/raw/driver_data.csv --sessions s3a://lake/raw/sessions.csv \\
        --fact demo.car_telemetry --average-speed demo.average_speed \\
        --avg-speed-gear demo.avg_speed_gear --partition-by year,location,full_name

Prints the run report as one JSON line.  Credentials and catalog settings
come from the submit configuration, never from this code.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from datetime import datetime
from pathlib import Path
from zoneinfo import ZoneInfo

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Incremental telemetry ingest and daily models")
    p.add_argument("--car", required=True, help="car CSV folder (tree) or glob")
    p.add_argument("--layout", default="A", choices=["A", "B", "a", "b"])
    p.add_argument("--recursive", action="store_true", help="read every file below --car")
    p.add_argument("--positional", action="store_true", help="bind CSV columns by position")
    p.add_argument("--files-modified-after", default=None,
                   help="read only car files modified after this time (YYYY-MM-DDTHH:mm:ss, session "
                        "zone), or 'auto': the previous logged run's start minus --modified-margin")
    p.add_argument("--modified-margin", type=int, default=3600,
                   help="seconds subtracted from the previous run's start for 'auto' (clock skew)")
    p.add_argument("--new-files-only", action="store_true",
                   help="read only car files that no earlier run into this fact took in")
    p.add_argument("--input-ledger", default=None, help="folder of the ledger of files taken in (default: <fact-path>_input)")
    p.add_argument("--run-log", default=None, help="run-log table (default: <fact>_runs)")
    p.add_argument("--bad-lines", default=None, help="table that lines with bad fields are copied to")
    p.add_argument("--bad-lines-path", default=None, help="external location of that table")
    p.add_argument("--drivers", required=True)
    p.add_argument("--sessions", required=True)
    p.add_argument("--fact", required=True, help="fact table name")
    p.add_argument("--fact-path", default=None, help="external location of the fact table")
    p.add_argument("--average-speed", default=None)
    p.add_argument("--avg-speed-gear", default=None)
    p.add_argument("--average-speed-path", default=None, help="external location of the average_speed table")
    p.add_argument("--avg-speed-gear-path", default=None, help="external location of the avg_speed_gear table")
    p.add_argument("--format", default="parquet", help="table format of the fact")
    p.add_argument("--partition-by", default="year,location,full_name")
    p.add_argument("--no-year", action="store_true", help="do not add the year column")
    p.add_argument("--driver-keys", default="driver_number")
    p.add_argument("--full-model-refresh", action="store_true",
                   help="recompute every day of the aggregates (default: only touched days)")
    p.add_argument("--database", default=None, help="CREATE DATABASE IF NOT EXISTS first")
    p.add_argument("--on-schema-change", default="sync_all_columns", choices=["sync_all_columns", "fail", "ignore"],
                   help="what becomes of columns that come or go; 'ignore' leaves new ones out")
    p.add_argument("--shuffle-gb", type=int, default=None, help="the most that one shuffle is expected to carry; widens it beyond 1 TB")
    p.add_argument("--profile", default="cluster", choices=["cluster", "local"],
                   help="session sizing (cluster: wide shuffles coalesced by AQE)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    from paddock.plans import ingest
    from paddock.session import build_session
    from paddock.sources import files, tables

    a = parse_args(argv)
    started = int(time.time())
    spark = build_session(app_name="paddock-daily", profile=a.profile, shuffle_bytes=a.shuffle_gb << 30 if a.shuffle_gb else None)
    if a.database:
        tables.ensure_database(spark, a.database)
    log_table = a.run_log or f"{a.fact}_runs"
    log_path = f"{a.fact_path.rstrip('/')}_runs" if a.fact_path else None
    modified_after = a.files_modified_after
    if modified_after == "auto":
        # Raw files are written once: files older than the previous run's start
        # (less a margin for clock skew) were all read by an earlier run.
        previous = ingest.last_run_started(spark, log_table, a.fact, log_path, a.fact_path, source=a.car)
        zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone", "UTC"))
        modified_after = (
            datetime.fromtimestamp(previous - a.modified_margin, zone).strftime("%Y-%m-%dT%H:%M:%S")
            if previous is not None else None
        )
    taken = None
    if a.new_files_only:
        ledger = a.input_ledger or (f"{a.fact_path.rstrip('/')}_input" if a.fact_path else None)
        if ledger is None:
            raise SystemExit("--new-files-only needs --input-ledger or --fact-path")
        taken = ingest.NewCarFiles(spark, ledger, a.fact, a.fact_path, a.format)
        car = taken.read(a.car, a.layout, recursive=a.recursive, positional=a.positional, bad_lines=bool(a.bad_lines))
    else:
        car = files.read_car_csv(spark, a.car, a.layout, recursive=a.recursive, positional=a.positional,
                                 modified_after=modified_after, bad_lines=bool(a.bad_lines))
    drivers = files.read_drivers(spark, a.drivers)
    sessions = files.read_sessions(spark, a.sessions)
    parts = tuple(c for c in a.partition_by.split(",") if c)
    keys = tuple(c for c in a.driver_keys.split(",") if c)
    set_aside = ingest.set_aside(car, a.bad_lines, a.bad_lines_path) if a.bad_lines else None
    car = car.drop(files.BAD_LINE, "_file")
    if a.average_speed and a.avg_speed_gear:
        report = ingest.run_daily(
            spark, car, drivers, sessions,
            ingest.DailyTables(a.fact, a.average_speed, a.avg_speed_gear, a.fact_path, a.average_speed_path, a.avg_speed_gear_path),
            partition_cols=parts, incremental_models=not a.full_model_refresh,
            add_year=not a.no_year, driver_keys=keys, on_schema_change=a.on_schema_change, fmt=a.format,
        )
    else:
        report = ingest.run_ingest(spark, car, drivers, sessions, a.fact, partition_cols=parts,
                                   add_year=not a.no_year, driver_keys=keys, path=a.fact_path,
                                   on_schema_change=a.on_schema_change, fmt=a.format)
    if taken is not None:
        taken.done()
    ingest.log_run(spark, log_table, report, started, log_path, source=a.car)
    out = {k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in report.as_dict().items()}
    out["files_modified_after"] = modified_after
    if set_aside is not None:
        out["bad_lines"] = set_aside
    if taken is not None:
        out["files_read"] = len(taken.changes.fresh)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
