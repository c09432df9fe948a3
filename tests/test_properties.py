"""Properties against brute-force Python models, plus skew and import hygiene."""

from __future__ import annotations

import importlib
import pkgutil
import subprocess
import sys

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import REPO
from test_plans import plan
from paddock.operators import checks, incremental, joins, merge

KEYS = ["a", "b"]
SCHEMA = "a int, b int, v int"
key = st.one_of(st.none(), st.integers(0, 3))
row = st.tuples(key, key, st.integers(0, 99))


def _model_upsert(target, source, null_safe):
    """SQL MERGE: a matched target row takes its source row's values (source
    keys are unique), unmatched target rows stay, unmatched source rows are
    inserted."""
    def match(t, s):
        if null_safe:
            return t[0] == s[0] and t[1] == s[1]
        return None not in (t[0], t[1], s[0], s[1]) and t[0] == s[0] and t[1] == s[1]

    out = []
    for t in target:
        hits = [s for s in source if match(t, s)]
        out.append(hits[0] if hits else t)
    out += [s for s in source if not any(match(t, s) for t in target)]
    return sorted(out, key=repr)


def _model_delete_insert(target, source, null_safe):
    def match(t, s):
        if null_safe:
            return t[0] == s[0] and t[1] == s[1]
        return None not in (t[0], t[1], s[0], s[1]) and t[0] == s[0] and t[1] == s[1]

    return sorted(source + [t for t in target if not any(match(t, s) for s in source)], key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.lists(row, max_size=8),
    source=st.lists(row, max_size=8, unique_by=lambda r: (r[0], r[1])),
    null_safe=st.booleans(),
)
def test_upsert_rows_matches_model(spark, target, source, null_safe):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    got = sorted(map(tuple, merge.upsert_rows(t, s, KEYS, null_safe).collect()), key=repr)
    assert got == _model_upsert(target, source, null_safe)
    # With unique target keys MERGE equals "source + target rows it does not replace".
    dedup = list({(r[0], r[1]): r for r in target}.values())
    if len(dedup) == len(target) and (null_safe or all(None not in r[:2] for r in target)):
        assert got == _model_delete_insert(target, source, null_safe)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    source=st.lists(st.integers(0, 50), max_size=12),
    target=st.lists(st.integers(0, 50), max_size=6),
)
def test_newer_than_matches_model(spark, source, target):
    src = spark.createDataFrame([(x,) for x in source], "d int")
    tgt = spark.createDataFrame([(x,) for x in target], "d int")
    got = sorted(r.d for r in incremental.newer_than(src, tgt, "d").collect())
    wm = max(target) if target else None
    assert got == sorted(x for x in source if wm is None or x > wm)
    assert sorted(r.d for r in incremental.newer_than_value(src, "d", wm).collect()) == got


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=12))
def test_unique_matches_model(spark, ids):
    df = spark.createDataFrame([(x,) for x in ids], "id int")
    got = {r.unique_field: r.n_records for r in checks.unique(df, "id").collect()}
    want = {x: ids.count(x) for x in set(ids) if x is not None and ids.count(x) > 1}
    assert got == want
    assert checks.not_null(df, "id").count() == ids.count(None)


def test_hot_key_over_a_large_dimension_is_split(spark):
    """A key with a third of the fact rows, joined to a dimension too large to
    broadcast: AQE splits the hot partition instead of one task taking it."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30_000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
            F.col("id").alias("v"),
        )
        dim = joins.dimension(spark.range(1000).withColumnRenamed("id", "k2"), max_rows=100)
        j = fact.join(dim, fact.k == dim.k2)
        assert len(j.collect()) == n
        final = plan(j, "simple")  # after execution: the final adaptive plan
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_modules_import_without_starting_spark():
    """Like a DAG import test: every module imports cleanly and none builds a
    session at import time."""
    code = (
        "import importlib, pkgutil, sys\n"
        f"sys.path.insert(0, {str(REPO)!r})\n"
        "import paddock\n"
        "for m in pkgutil.walk_packages(paddock.__path__, 'paddock.'):\n"
        "    importlib.import_module(m.name)\n"
        "import __spark_entry__\n"
        "from pyspark.sql import SparkSession\n"
        "assert SparkSession.getActiveSession() is None\n"
        "print('ok')\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().endswith("ok")


def test_every_registered_query_has_an_oracle_and_a_unique_name():
    import __spark_entry__ as ent
    from paddock.plans import registry

    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
    assert set(registry.QUERIES) <= set(ent.queries()) and set(ent.oracle_sql()) <= set(ent.queries())
    for m in pkgutil.walk_packages(importlib.import_module("paddock").__path__, "paddock."):
        importlib.import_module(m.name)


def test_hot_partition_value_is_written_by_several_tasks(spark, workdir):
    """A partition value holding a third of the rows is split across tasks."""
    import os
    import uuid

    from paddock.plans import sinks

    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 60_000
        df = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("p"),
            F.col("id"), (F.col("id") * 7).alias("v"),
        )
        name = f"hotpart_{uuid.uuid4().hex[:8]}"
        sinks.create_table(df, name, ["p"], path=f"{workdir}/{name}")
        hot_files = [f for f in os.listdir(f"{workdir}/{name}/p=hot") if f.endswith(".parquet")]
        assert len(hot_files) > 1
        assert spark.table(name).count() == n
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
