"""The daily speed models as a function of the fact's files.

An average can't be brought up to date from itself, but a sum and a count can.  Beside the models a
state is kept: speed sums and counts per team, driver, location, day and gear, one part for each
run that took in files of the fact (``file_ledger``).  A refresh

1. compares the fact's files with the ledger.  Files that came (appended, late, of any age) are read,
   and only they; files that were replaced or removed (a rebuilt fact) take their part of the
   state with them;
2. writes the new part, then commits it;
3. brings each model from the commit that it was made at to this one: days of parts that were added are
   added up again, over all parts in force, and replace the model's partitions; when parts went, or
   the model is not as it was left, all days are.  No row of the fact is read for it.

So the models always equal a recompute over the fact's present content, whatever happened to it, and a
run costs what is new in it.  A forced refresh reads the whole fact anew.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paddock.operators import models
from paddock.plans import sinks
from paddock.plans.file_ledger import FileLedger, listing, read_if_present
from paddock.sources.files import literal_path

APPLIED_SCHEMA = "at BIGINT, model STRING, version BIGINT, content STRING"


@dataclass(frozen=True)
class Model:
    """An aggregate table made from the state."""

    table: str
    make: Callable[[DataFrame], DataFrame]
    path: str | None = None


def speed_models(average_speed: str, avg_speed_gear: str, path_average_speed: str | None = None,
                 path_avg_speed_gear: str | None = None) -> list[Model]:
    return [
        Model(average_speed, models.average_speed_from_partials, path_average_speed),
        Model(avg_speed_gear, lambda p: models.avg_speed_gear_from_partials(models.merged_partials(p)), path_avg_speed_gear),
    ]


def scan_files(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    """The rows of these files of a file table, with its columns."""
    whole = spark.table(table)
    if not paths:
        return whole.where(F.lit(False))
    reader = spark.read.format(sinks.table_provider(spark, table) or "parquet").schema(whole.schema)
    return reader.option("basePath", sinks.table_location(spark, table)).load([literal_path(p) for p in paths]).select(*whole.columns)


class SpeedState:
    """The state of one fact table, below ``root``."""

    def __init__(self, spark: SparkSession, fact: str, root: str):
        self.spark, self.fact, self.root = spark, fact, root.rstrip("/")
        self.ledger = FileLedger(spark, f"{self.root}/ledger")
        self.schema = models.speed_partials(spark.table(fact)).schema

    def partials(self, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(StructType([*self.schema.fields, StructField("run", StringType())]))
        return rows.parquet(f"{self.root}/partials").where(F.col("run").isin(runs)).drop("run")

    def bring_up(self, anew: bool = False) -> tuple[int, list]:
        """Take in the fact's files; returns (version, the ledger's history)."""
        files = listing(self.spark, sinks.table_location(self.spark, self.fact))
        history = self.ledger.history()
        changes = self.ledger.changes(files, history, anew)
        if not changes:
            return changes.version, history
        run = self.ledger.new_run() if changes.fresh else None
        if run:
            part = models.speed_partials(scan_files(self.spark, self.fact, changes.fresh))
            part.write.mode("errorifexists").parquet(f"{self.root}/partials/run={run}")
        return changes.version + 1, [*history, *self.ledger.commit(changes, run)]

    def applied(self) -> dict[str, tuple[int, str]]:
        """For each model's table the version that it was last brought to, and its content then."""
        rows = read_if_present(self.spark, f"{self.root}/applied", APPLIED_SCHEMA)
        last = rows.groupBy("model").agg(F.max_by(F.struct("version", "content"), "at").alias("s")).collect()
        return {r["model"]: (r["s"]["version"], r["s"]["content"]) for r in last}

    def record(self, version: int, changed: list[str]) -> None:
        at = time.time_ns()
        rows = [(at, m, version, content(self.spark, m)) for m in changed]
        self.spark.createDataFrame(rows, APPLIED_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/applied")


def content(spark: SparkSession, table: str) -> str:
    """A hash of the names of a table's files; a write, whoever makes it, changes it."""
    spark.catalog.refreshTable(table)  # another process's write isn't in this one's file list
    return sha256("\n".join(sorted(spark.table(table).inputFiles())).encode()).hexdigest()


def _touched_days(state: SpeedState, before: list[str], now: list[str]) -> list | None:
    """Days of the parts that came since ``before``; None (all days) if parts went, or days are too many to name."""
    if set(before) - set(now):
        return None
    days = state.partials([r for r in now if r not in before]).select("date").distinct().limit(sinks.MAX_PRUNING_VALUES + 1).collect()
    return [r["date"] for r in days] if len(days) <= sinks.MAX_PRUNING_VALUES else None


def _on(days: list) -> Column:
    """The date is one of these days, null included."""
    present = [d for d in days if d is not None]
    return F.coalesce(F.col("date").isin(present), F.lit(len(present) < len(days))) if present else F.col("date").isNull()


def refresh(spark: SparkSession, fact: str, targets: list[Model], root: str | None = None, *, anew: bool = False) -> bool:
    """Bring the models up to the fact's present content; True if a model changed.

    ``root`` is where the state is kept, beside the fact by default.  ``anew`` reads the whole fact and
    rewrites all models.  The fact must be a file table whose location holds its files and no others.
    """
    state = SpeedState(spark, fact, root or f"{sinks.table_location(spark, fact)}_speed_state")
    version, history = state.bring_up(anew)
    runs, applied = state.ledger.runs(history), state.applied()
    days: dict[int | None, list | None] = {None: None}  # by the version that a model is at
    changed = []
    for model in targets:
        sinks.attach_if_present(spark, model.table, model.path)
        exists = sinks.table_exists(spark, model.table)
        at, left = applied.get(model.table, (None, None))
        if not exists or left != content(spark, model.table):
            at = None  # not made from this state, or changed since: all days are made anew
        if at == version:
            continue
        if at not in days:
            days[at] = _touched_days(state, state.ledger.runs(history, at), runs)
        some, rows = days[at], state.partials(runs)
        rows = model.make(rows if some is None else rows.where(_on(some)))
        if not exists:
            sinks.create_table(rows, model.table, ["date"], path=model.path)
        elif some is None:
            sinks.refresh(rows, model.table, ["date"], path=model.path)
        else:
            sinks.sync_all_columns(spark, model.table, rows.schema)
            sinks.replace_partitions(rows, model.table, ["date"])
        changed.append(model.table)
    if changed:
        state.record(version, changed)
    return bool(changed)
