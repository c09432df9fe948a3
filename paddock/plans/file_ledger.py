"""Which files of a folder have been taken in, kept as a small Parquet log.

Files are taken in by *runs*.  Every change of the ledger is one file of the log: the run that came,
with its files by path, length and modification time, and the runs that went.  It is written in one
piece and last; what a run wrote elsewhere before it died is in no log file and is never read.

``changes`` compares a listing with the log.  A file that was replaced or removed takes its whole
run out of force, and what is left of that run counts as new; so whatever is kept per
run always belongs to files that are there as they were read.  ``unseen`` only looks for files
that no run took in.

The comparison is a join; only new files' paths reach the driver, where Spark plans their
scan from them.  One writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.sources.files import path_exists

IDENTITY = ["file", "length", "modified"]
FILE_SCHEMA = "file STRING, length BIGINT, modified TIMESTAMP"
LOG_SCHEMA = f"version BIGINT, run STRING, came BOOLEAN, note STRING, {FILE_SCHEMA}"


def listing(spark: SparkSession, path: str, recursive: bool = True, pattern: bool = False) -> DataFrame:
    """The files below a folder, or with ``pattern`` those that a glob matches, without opening any; hidden ones are left out."""
    if not pattern and not path_exists(spark, path):
        return spark.createDataFrame([], FILE_SCHEMA)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return found.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def read_if_present(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, empty if there is none yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


@dataclass
class Changes:
    """What has to be done to bring a ledger up to a listing."""

    now: DataFrame
    version: int
    kept: list[str]  # runs in force before and still
    gone: list[str]  # runs no longer in force
    fresh: list[str]  # paths to take in

    def __bool__(self) -> bool:
        return bool(self.fresh or self.gone)


class Entry(NamedTuple):
    """A run came into force, with what was noted of it, or went."""

    version: int
    run: str
    came: bool
    note: str | None = None


class FileLedger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/log"

    def log(self) -> DataFrame:
        return read_if_present(self.spark, self.path, LOG_SCHEMA)

    def history(self) -> list[Entry]:
        """What became of every run, in order."""
        rows = self.log().select("version", "run", "came", "note").distinct().collect()
        return sorted((Entry(*r) for r in rows), key=lambda e: (e.version, e.came, e.run))

    @staticmethod
    def in_force(history: list[Entry], version: int | None = None) -> list[Entry]:
        """The runs in force, now or at a version."""
        until = [e for e in history if version is None or e.version <= version]
        went = {e.run for e in until if not e.came}
        return [e for e in until if e.came and e.run not in went]

    def runs(self, history: list[Entry], version: int | None = None) -> list[str]:
        return [e.run for e in self.in_force(history, version)]

    def _files(self, runs: list[str]) -> DataFrame:
        return self.log().where(F.col("came") & F.col("run").isin(runs)).select("run", *IDENTITY)

    def changes(self, now: DataFrame, history: list[Entry], anew: bool = False) -> Changes:
        """What is new in a listing; ``anew`` takes every run out of force."""
        version, runs = max((e.version for e in history), default=0), self.runs(history)
        if anew or not runs:
            return Changes(now, version, [], runs, [r["file"] for r in now.select("file").collect()])
        both = now.withColumn("here", F.lit(True)).join(self._files(runs), IDENTITY, "full_outer")
        odd = both.where(F.col("here").isNull() | F.col("run").isNull())
        found = odd.select(F.when(F.col("here"), F.col("file")).alias("file"), "run").distinct().collect()
        gone = sorted({r["run"] for r in found if r["run"] is not None})
        fresh = [r["file"] for r in found if r["run"] is None]
        if gone:  # their other files are taken in again
            fresh += [r["file"] for r in now.join(self._files(gone), IDENTITY, "left_semi").select("file").collect()]
        return Changes(now, version, [r for r in runs if r not in gone], gone, fresh)

    def unseen(self, now: DataFrame) -> Changes:
        """The files of a listing that no run took in; files that went don't matter."""
        history = self.history()
        runs = self.runs(history)
        fresh = now.join(self._files(runs), IDENTITY, "left_anti") if runs else now
        return Changes(now, max((e.version for e in history), default=0), runs, [], [r["file"] for r in fresh.select("file").collect()])

    @staticmethod
    def new_run() -> str:
        return f"r{uuid.uuid4().hex[:16]}"

    def commit(self, changes: Changes, run: str | None, note: str | None = None) -> list[Entry]:
        """Put ``run`` in force for the fresh files and take the gone ones out; returns the new entries."""
        version = F.lit(changes.version + 1).alias("version")
        paths = self.spark.createDataFrame([(p,) for p in changes.fresh], "file STRING")
        # the files as they were listed, not those of another look at the folder
        rows = changes.now.join(paths, "file", "left_semi").select(version, F.lit(run).alias("run"), F.lit(True).alias("came"), F.lit(note).cast("string").alias("note"), *IDENTITY)
        if changes.gone:
            went = self.spark.createDataFrame([(r,) for r in changes.gone], "run STRING")
            missing = [F.lit(None).cast(t).alias(c) for c, t in zip(IDENTITY, ("string", "long", "timestamp"))]
            rows = rows.union(went.select(version, "run", F.lit(False), F.lit(None).cast("string"), *missing))
        rows.coalesce(1).write.mode("append").parquet(self.path)
        came = [Entry(changes.version + 1, run, True, note)] if changes.fresh else []
        return [*(Entry(changes.version + 1, r, False) for r in changes.gone), *came]
