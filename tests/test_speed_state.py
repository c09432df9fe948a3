"""The daily models follow the fact's files: what is read, what is made anew, what a crash leaves."""

from __future__ import annotations

import datetime as dt
import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from paddock.operators import models
from paddock.plans import file_ledger, ingest, sinks, speed_state

SCHEMA = "team_name string, full_name string, location string, date timestamp_ntz, n_gear int, speed int, year int"


def rows(*items):
    """(driver, day, gear, speed) as fact rows; one driver's name needs escaping in a path."""
    return [("Red", d, "Sao Paulo/1", dt.datetime(2024, 1, day, 12), gear, speed, 2024) if day else
            ("Red", d, "Sao Paulo/1", None, gear, speed, None) for d, day, gear, speed in items]


class Fixture:
    def __init__(self, spark, root):
        tag = uuid.uuid4().hex[:8]
        self.spark, self.root = spark, root
        self.fact, self.avg, self.gear = (f"{n}_{tag}" for n in ("fact", "avg", "gear"))
        self.targets = speed_state.speed_models(self.avg, self.gear, f"{root}/avg", f"{root}/gear")

    def add(self, *items):
        df = self.spark.createDataFrame(rows(*items), SCHEMA).coalesce(1)
        sinks.create_or_append(df, self.fact, ["year", "full_name"], path=f"{self.root}/fact")

    def refresh(self, **given):
        return speed_state.refresh(self.spark, self.fact, self.targets, **given)

    def equal(self):
        fact = self.spark.table(self.fact)
        for table, model in ((self.avg, models.average_speed), (self.gear, models.avg_speed_gear)):
            want = model(fact)
            got = self.spark.table(table).select(*want.columns).collect()
            assert sorted(map(str, got)) == sorted(map(str, want.collect())), table

    def files(self, table):
        return sorted(self.spark.table(table).inputFiles())


@pytest.fixture()
def f(spark, workdir):
    return Fixture(spark, workdir)


def test_only_new_files_are_read_and_only_their_days_made_anew(f, spark):
    f.add(("a b", 1, 3, 100), ("a b", 2, 3, 200), ("c=d", 1, 4, None), ("c=d", None, 4, 7))
    assert f.refresh()
    f.equal()
    before = f.files(f.avg)
    # the old files can't be read any more, but nobody notices: same name, length and time
    kept = {}
    for path in glob.glob(f"{f.root}/fact/**/*.parquet", recursive=True):
        body, at = open(path, "rb").read(), os.stat(path)
        kept[path] = body, at
        with open(path, "wb") as out:
            out.write(b"x" * len(body))
        os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    f.add(("a b", 2, 5, 50), ("c=d", 3, 1, 9), ("c=d", 1, 4, 11))
    assert f.refresh()
    assert not f.refresh()
    for path, (body, at) in kept.items():
        with open(path, "wb") as out:
            out.write(body)
        os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
    f.equal()
    # the partition without a date got no new rows: its file stayed
    assert [p for p in f.files(f.avg) if "HIVE_DEFAULT" in p] == [p for p in before if "HIVE_DEFAULT" in p] != []
    assert not f.refresh()


def test_rows_without_a_date_and_late_rows(f):
    f.add(("x", 20, 1, 10))
    f.refresh()
    f.add(("x", 3, 1, 30), ("x", None, 1, 5), ("y", None, None, None))  # below the watermark, and without one
    assert f.refresh()
    f.equal()


def test_rebuilt_emptied_and_partly_removed_facts(f, spark):
    f.add(("x", 1, 1, 10), ("y", 1, 1, 10), ("x", 2, 2, 20))
    f.add(("x", 2, 2, 40))
    f.refresh()
    sinks.refresh(spark.createDataFrame(rows(("x", 1, 1, 900)), SCHEMA), f.fact, ["year", "full_name"])
    assert f.refresh()
    f.equal()
    assert spark.table(f.avg).count() == 1  # groups and days that are gone are gone
    f.add(("y", 5, 1, 1))
    f.refresh()
    removed = [p for p in f.files(f.fact) if "full_name=x" in p]
    for p in removed:
        os.remove(p.removeprefix("file://"))
    spark.sql(f"REFRESH TABLE {f.fact}")
    assert f.refresh()
    f.equal()
    sinks.refresh(spark.createDataFrame([], SCHEMA), f.fact, ["year", "full_name"])
    f.refresh()
    assert spark.table(f.gear).count() == 0


def test_forced_refresh_and_a_model_that_was_changed_by_hand(f, spark):
    f.add(("x", 1, 1, 10), ("y", 2, 1, 30))
    f.refresh()
    wrong = spark.table(f.avg).withColumn("average_speed", F.lit(-1.0))
    sinks.refresh(sinks.stage_parquet(wrong), f.avg, ["date"])
    assert f.refresh()  # seen without being asked
    f.equal()
    before = f.files(f.gear)
    assert f.refresh(anew=True)
    assert f.files(f.gear) != before
    f.equal()


def test_a_run_that_died_and_a_model_that_was_dropped(f, spark):
    f.add(("x", 1, 1, 10))
    f.refresh()
    f.add(("x", 1, 1, 30), ("z", 4, 2, 2))
    state = speed_state.SpeedState(spark, f.fact, f"{sinks.table_location(spark, f.fact)}_speed_state")
    commit, state.ledger.commit = state.ledger.commit, None
    with pytest.raises(TypeError):
        state.bring_up()  # the part is written, its commit is not
    state.ledger.commit = commit
    state.bring_up()  # committed, but no model was brought up
    assert f.refresh()
    f.equal()
    spark.sql(f"DROP TABLE {f.gear}")
    f.targets[1] = speed_state.Model(f.gear, f.targets[1].make, f"{f.root}/gear_again")
    assert f.refresh()
    f.equal()


def test_models_attached_by_path_stay_known(f, spark):
    """As with a catalog that forgets its tables when the process ends."""
    f.add(("x", 1, 1, 10))
    f.refresh()
    for t in (f.fact, f.avg, f.gear):
        spark.sql(f"DROP TABLE {t}")  # external: the folders stay
    sinks.attach_if_present(spark, f.fact, f"{f.root}/fact")
    assert not f.refresh()
    f.add(("x", 2, 1, 10))
    assert f.refresh()
    f.equal()


def test_ledger_compares_path_length_and_time(spark, workdir):
    folder = f"{workdir}/in"
    os.makedirs(folder)
    for name in ("a.csv", "b.csv"):
        with open(f"{folder}/{name}", "w") as out:
            out.write("1\n")
    ledger = file_ledger.FileLedger(spark, f"{workdir}/ledger")
    look = lambda: file_ledger.listing(spark, folder)
    assert ledger.history() == [] and file_ledger.listing(spark, f"{workdir}/none").count() == 0
    first = ledger.changes(look(), [])
    assert len(first.fresh) == 2 and [e.version for e in ledger.commit(first, "r1", "noted")] == [1]
    assert not ledger.changes(look(), ledger.history()) and not ledger.unseen(look())
    with open(f"{folder}/a.csv", "w") as out:
        out.write("12\n")  # replaced under its name
    changed = ledger.changes(look(), ledger.history())
    assert changed.gone == ["r1"] and len(changed.fresh) == 2  # its run is taken in anew
    assert [os.path.basename(p) for p in ledger.unseen(look()).fresh] == ["a.csv"]
    added = ledger.commit(changed, "r2")
    history = ledger.history()
    assert history[1:] == added and [e.note for e in history] == ["noted", None, None]
    assert ledger.runs(history) == ["r2"] and ledger.runs(history, 1) == ["r1"]
