"""Lost tasks are retried without changing results or counts.

A subprocess runs with ``local[4,4]`` (a task may fail up to four times) and a
test-only wrapper that fails the first attempt of every task reading the car
files.  The ingest must still write each row once, and the observed counts
must not include the failed attempts; an upsert whose source fails the same
way must give the same table as without failures.
"""

from __future__ import annotations

import subprocess
import sys

from conftest import REPO, write_text
from test_golden_ingest import BATCH1, CAR_COLUMNS_A, DRIVER_COLUMNS, DRIVERS, SESSION_COLUMNS, SESSIONS, _car_rows, _csv

PROGRAM = """
import sys
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from paddock.session import build_session
from paddock.plans import ingest, sinks
from paddock.operators import models
from paddock.schemas import AVERAGE_SPEED_KEYS
from paddock.sources import files

spark = build_session("local[4,4]", shuffle_partitions=4)
spark.sparkContext.setCheckpointDir({root!r} + "/ckpt")
root = {root!r}

def flaky(batches):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected loss of this task")
    yield from batches

drivers = files.read_drivers(spark, root + "/drivers.csv")
sessions = files.read_sessions(spark, root + "/sessions.csv")
car = files.read_car_csv(spark, root + "/car", recursive=True)
car = car.mapInPandas(flaky, car.schema)
r = ingest.run_ingest(spark, car, drivers, sessions, "ft_fact", path=root + "/fact")
print("ingest", r.new_fact_rows, r.rows_written, r.table_rows, spark.table("ft_fact").count())

fact = spark.table("ft_fact")
src = models.average_speed(fact.mapInPandas(flaky, fact.schema))
sinks.upsert(src, "ft_avg", AVERAGE_SPEED_KEYS, path=root + "/avg")
sinks.upsert(src, "ft_avg", AVERAGE_SPEED_KEYS)
print("upsert", sorted((r.location, str(r.date), r.average_speed) for r in spark.table("ft_avg").collect()))
spark.stop()
"""


def test_retried_tasks_change_nothing(workdir):
    root = workdir
    write_text(f"{root}/drivers.csv", _csv(DRIVER_COLUMNS, [
        dict(driver_number=n, full_name=f, team_name=t) for n, f, t in DRIVERS]))
    write_text(f"{root}/sessions.csv", _csv(SESSION_COLUMNS, [
        dict(session_key=k, location=loc, country_name=c) for k, loc, c in SESSIONS]))
    write_text(f"{root}/car/x/one.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH1)))
    out = subprocess.run([sys.executable, "-c", PROGRAM.format(repo=str(REPO), root=root)],
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "injected loss of this task" in out.stderr  # failures did happen
    lines = out.stdout.strip().splitlines()
    assert "ingest 6 6 6 6" in lines
    assert ("upsert [('Monza', '2023-09-01', 290.0), ('Monza', '2023-09-01', 305.0), "
            "('Suzuka', '2023-09-22', 280.0)]") in lines
