"""Raw files are taken in once each, whatever their name, age or folder; the gate commits nothing."""

from __future__ import annotations

import os
import uuid

from conftest import write_text
from paddock.plans import ingest, sinks
from test_golden_ingest import BATCH1, BATCH2, CAR_COLUMNS_A, _car_rows, _csv, _dims, raw  # noqa: F401


def run(spark, raw, fact, source, recursive=True, dies=False):  # noqa: F811
    drivers, sessions = _dims(spark, raw)
    path = f"{raw}/tables/{fact}"
    taken = ingest.NewCarFiles(spark, f"{path}_input", fact, path)
    car = taken.read(source, "A", recursive=recursive)
    report = ingest.run_ingest(spark, car, drivers, sessions, fact, path=path)
    if not dies:
        taken.done()
    return report, sorted(os.path.basename(p) for p in taken.changes.fresh)


def test_files_are_read_once_and_late_or_renamed_ones_are_not_missed(spark, raw):  # noqa: F811
    fact, source = f"files_{uuid.uuid4().hex[:8]}", f"{raw}/car_data"
    report, read = run(spark, raw, fact, source)
    assert (report.rows_written, read) == (6, ["batch1.csv"])
    report, read = run(spark, raw, fact, source)
    assert (report.rows_written, report.table_rows, read) == (0, 6, [])
    # copied late, with a time from long ago and a name that a glob would misread
    old = write_text(f"{source}/2020/batch[2]{{x}}*?.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    os.utime(old, (1_500_000_000, 1_500_000_000))
    report, read = run(spark, raw, fact, source, dies=True)  # loaded, but the run died before it said so
    assert (report.rows_written, len(read)) == (2, 1)
    report, read = run(spark, raw, fact, source)
    assert (report.rows_written, len(read)) == (0, 1)  # read again, nothing loaded twice
    # another folder of the same fact is read whole
    late = [(1, 111, 3, "2023-09-23 05:00:02.000", 200)]
    write_text(f"{raw}/car_new/a.csv", _csv(CAR_COLUMNS_A, _car_rows(late)))
    report, read = run(spark, raw, fact, f"{raw}/car_new/*.csv", recursive=False)
    assert (report.rows_written, report.table_rows, read) == (1, 9, ["a.csv"])
    # the fact is gone: all files count again
    spark.sql(f"DROP TABLE {fact}")
    import shutil

    shutil.move(f"{raw}/tables/{fact}", f"{raw}/tables/{fact}_old")
    report, read = run(spark, raw, fact, source)
    assert report.created and len(read) == 2 and report.rows_written == 10


def test_the_run_log_of_another_input_skips_no_file(spark, raw):  # noqa: F811
    tag = f"input_{uuid.uuid4().hex[:8]}"
    drivers, sessions = _dims(spark, raw)
    report, _ = run(spark, raw, tag, f"{raw}/car_data")
    log = f"{tag}_runs"
    # a log from before inputs were logged
    old = spark.createDataFrame([(5, tag, True, None, 6, 6, 6, None)], ingest.RUN_LOG_SCHEMA.replace(" input STRING,", ""))
    sinks.create_table(old, log, path=f"{raw}/tables/{log}")
    assert ingest.last_run_started(spark, log, tag, source="a") is None
    ingest.log_run(spark, log, report, 7, source="a")
    ingest.log_run(spark, log, report, 9, source="b")
    assert [ingest.last_run_started(spark, log, tag, source=s) for s in ("a", "b", "c", None)] == [7, 9, None, 9]


def test_a_run_without_new_rows_commits_nothing(spark, raw):  # noqa: F811
    from pyspark.sql import functions as F

    from paddock.sources import files

    fact = f"gate_{uuid.uuid4().hex[:8]}"
    drivers, sessions = _dims(spark, raw)
    path = f"{raw}/tables/{fact}"
    car = files.read_car_csv(spark, f"{raw}/car_data", "A")
    ingest.run_ingest(spark, car, drivers, sessions, fact, path=path)

    def now():
        return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names}

    before, schema = now(), spark.table(fact).schema
    report = ingest.run_ingest(spark, car.where(F.col("rpm") > 0), drivers, sessions, fact, on_schema_change="sync_all_columns")
    assert not report.wrote and report.watermark_after == report.watermark_before and report.table_rows == 6
    assert now() == before and spark.table(fact).schema == schema


def unreadable(folder):
    """Spoil every data file below a folder, under its name, length and time; returns how to undo it."""
    import glob

    kept = {}
    for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        with open(path, "rb") as f:
            kept[path] = f.read(), os.stat(path)
    def put(spoil):  # noqa: E306
        for path, (body, at) in kept.items():
            with open(path, "wb") as out:
                out.write(b"x" * len(body) if spoil else body)
            os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
            crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    put(True)
    return lambda: put(False)


def test_a_run_reads_no_row_of_the_fact(spark, raw):  # noqa: F811
    """Totals, watermark and both models come from what is noted; the fact's old files can't even be read."""
    tag = uuid.uuid4().hex[:8]
    drivers, sessions = _dims(spark, raw)
    root = f"{raw}/tables"
    t = ingest.DailyTables(f"none_{tag}", f"avg_{tag}", f"gear_{tag}", f"{root}/none", f"{root}/avg", f"{root}/gear")

    def daily():
        from paddock.sources import files

        return ingest.run_daily(spark, files.read_car_csv(spark, f"{raw}/car_data", "A"), drivers, sessions, t)

    daily()
    undo = unreadable(f"{root}/none")
    write_text(f"{raw}/car_data/2023/09/batch2.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH2)))
    report = daily()
    again = daily()
    undo()
    assert (report.rows_written, report.table_rows, again.table_rows, again.wrote) == (2, 8, 8, False)
    assert spark.table(t.fact).count() == 8
    assert str(report.watermark_after) == str(again.watermark_after) == "2023-09-22 05:00:02"
    assert spark.table(t.average_speed).count() == 3


def test_totals_follow_other_writers_and_removed_rows(spark, raw):  # noqa: F811
    from paddock.sources import files

    fact = f"totals_{uuid.uuid4().hex[:8]}"
    drivers, sessions = _dims(spark, raw)
    path = f"{raw}/tables/{fact}"
    car = files.read_car_csv(spark, f"{raw}/car_data", "A")
    ingest.run_ingest(spark, car, drivers, sessions, fact, path=path)
    rows = sinks.stage_parquet(spark.table(fact))
    for df in (rows.where("speed = 280"), rows.where("false"), rows):
        sinks.append(df, fact)
        totals = ingest.FactTotals(spark, fact).current()
        assert totals == ingest.table_watermark(spark, fact)
    sinks.refresh(rows.where("location = 'Monza'"), fact, ["year", "location", "full_name"])
    assert ingest.FactTotals(spark, fact).current() == ingest.table_watermark(spark, fact)
    sinks.refresh(rows.where("false"), fact, ["year", "location", "full_name"])
    assert ingest.FactTotals(spark, fact).current() == (None, 0)


def test_bad_lines_are_set_aside_once(spark, raw):  # noqa: F811
    from paddock.sources import files

    fact, bad = f"aside_{uuid.uuid4().hex[:8]}", f"bad_{uuid.uuid4().hex[:8]}"
    drivers, sessions = _dims(spark, raw)
    good = _csv(CAR_COLUMNS_A, _car_rows(BATCH1))
    lines = ["1,1,fast,8,9,0,0,2023-09-01 14:00:00.000,100,1", "1,1,300,8,9,0,0,noon,100,1", "44,1,300", "x" * 5000]

    def run_once():
        car = files.read_car_csv(spark, f"{raw}/car_data", "A", bad_lines=True)
        return ingest.run_ingest(spark, car, drivers, sessions, fact, path=f"{raw}/tables/{fact}", bad_lines=bad, bad_lines_path=f"{raw}/tables/{bad}")

    report = run_once()
    assert (report.rows_written, report.bad_lines) == (6, 0) and not sinks.table_exists(spark, bad)
    write_text(f"{raw}/car_data/x.csv", "\n".join([good.splitlines()[0], *lines, lines[0]]) + "\n")
    report = run_once()
    assert report.bad_lines == 4
    got = {r.line: r.fields for r in spark.table(bad).collect()}
    assert set(got) == set(lines) and got[lines[0]] == 9 and got[lines[3]] == 0
    # as without setting them aside: no date, or one below the watermark
    assert report.rows_written == 0
    assert run_once().bad_lines == 0
