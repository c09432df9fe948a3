"""CSV reading rules and the file-stream variant."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import IntegerType, StructField, StructType

from conftest import write_text
from paddock.sources import files
from paddock.streaming import file_ingest
from test_golden_ingest import BATCH1, BATCH2, CAR_COLUMNS_A, DRIVERS, SESSIONS, _car_rows, _csv
from paddock.schemas import DRIVER_COLUMNS, SESSION_COLUMNS


def test_header_must_match_schema_unless_positional(spark, workdir):
    path = write_text(f"{workdir}/swapped.csv", "rpm,driver_number\n11000,44\n")
    schema = StructType([StructField("driver_number", IntegerType()), StructField("rpm", IntegerType())])
    with pytest.raises(Exception) as err:
        files.read_csv(spark, path, schema).collect()
    assert "header" in str(err.value).lower() or "schema" in str(err.value).lower()
    row = files.read_csv(spark, path, schema, positional=True).first()
    assert (row.driver_number, row.rpm) == (11000, 44)  # bound by position


def test_malformed_field_becomes_null(spark, workdir):
    path = write_text(f"{workdir}/bad.csv", "driver_number,rpm\nabc,5\n7,8\n")
    schema = StructType([StructField("driver_number", IntegerType()), StructField("rpm", IntegerType())])
    rows = {tuple(r) for r in files.read_csv(spark, path, schema).collect()}
    assert rows == {(None, 5), (7, 8)}


def test_recursive_vs_glob(spark, workdir):
    write_text(f"{workdir}/tree/a/one.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH1)))
    write_text(f"{workdir}/tree/b/c/two.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    write_text(f"{workdir}/flat/one.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH1)))
    assert files.read_car_csv(spark, f"{workdir}/tree", recursive=True).count() == 9
    assert files.read_car_csv(spark, f"{workdir}/flat/*.csv", recursive=False).count() == 6
    with pytest.raises(PySparkException):
        # Without recursion a folder of folders holds no readable files.
        files.read_car_csv(spark, f"{workdir}/tree/*.csv", recursive=False).count()


def test_layout_b_reads_alphabetical_files(spark, workdir):
    from paddock.schemas import CAR_COLUMNS_B

    write_text(f"{workdir}/b/one.csv", _csv(CAR_COLUMNS_B, _car_rows(BATCH1)))
    df = files.read_car_csv(spark, f"{workdir}/b/*.csv", "B", recursive=False)
    assert df.columns == CAR_COLUMNS_B
    assert sorted(r.speed for r in df.collect()) == sorted(b[1] for b in BATCH1)


def test_file_stream_loads_new_files_once_including_late_rows(spark, workdir):
    write_text(f"{workdir}/drivers.csv", _csv(DRIVER_COLUMNS, [
        dict(driver_number=n, full_name=f, team_name=t) for n, f, t in DRIVERS]))
    write_text(f"{workdir}/sessions.csv", _csv(SESSION_COLUMNS, [
        dict(session_key=k, location=loc, country_name=c) for k, loc, c in SESSIONS]))
    drivers = files.read_drivers(spark, f"{workdir}/drivers.csv")
    sessions = files.read_sessions(spark, f"{workdir}/sessions.csv")
    write_text(f"{workdir}/car/1/batch1.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH1)))
    out, ckpt = f"{workdir}/out", f"{workdir}/ckpt"

    def run():
        stream = file_ingest.car_stream(spark, f"{workdir}/car")
        file_ingest.run_file_ingest_once(spark, stream, drivers, sessions, out, ckpt)
        return spark.read.parquet(out).count()

    assert run() == 6
    assert run() == 6  # nothing new: nothing added
    write_text(f"{workdir}/car/2/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    # Files, not a max(date), decide what is new: the tie and the late row load too.
    assert run() == 6 + 1 + 2 + 1


def test_csv_timestamp_forms(spark, workdir):
    """ISO text with 'T' and an offset, and space-separated text, both parse."""
    import datetime as dt

    rows = [
        dict(driver_number=1, rpm=1, speed=300, n_gear=8, throttle=1, brake=0, drs=0,
             date="2023-09-16T13:00:00.179000+00:00", session_key=100, meeting_key=1),
        dict(driver_number=1, rpm=1, speed=301, n_gear=8, throttle=1, brake=0, drs=0,
             date="2023-09-16 13:00:01.5", session_key=100, meeting_key=1),
        dict(driver_number=1, rpm=1, speed=302, n_gear=8, throttle=1, brake=0, drs=0,
             date="2023-09-16T15:00:02+02:00", session_key=100, meeting_key=1),
    ]
    write_text(f"{workdir}/ts/one.csv", _csv(CAR_COLUMNS_A, rows))
    got = sorted((r.speed, r.date) for r in files.read_car_csv(spark, f"{workdir}/ts").collect())
    # Instants; collected as wall-clock times of the process zone (UTC here).
    assert got == [
        (300, dt.datetime(2023, 9, 16, 13, 0, 0, 179000)),
        (301, dt.datetime(2023, 9, 16, 13, 0, 1, 500000)),
        (302, dt.datetime(2023, 9, 16, 13, 0, 2)),
    ]


def test_modified_after_reads_only_new_files(spark, workdir):
    import os
    import time

    old = write_text(f"{workdir}/mod/a/old.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH1)))
    past = time.time() - 3 * 86400
    os.utime(old, (past, past))
    write_text(f"{workdir}/mod/b/new.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    cutoff = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(time.time() - 86400))
    assert files.read_car_csv(spark, f"{workdir}/mod").count() == 9
    assert files.read_car_csv(spark, f"{workdir}/mod", modified_after=cutoff).count() == 3
