"""Columns that come and go: which changes leave the files alone, and that nothing comes back to life."""

from __future__ import annotations

import uuid

import pytest

from paddock.plans import sinks


@pytest.fixture()
def table(spark, workdir):
    name = f"sync_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1, "a", 1.5, "x y"), (2, None, 2.5, None)], "id int, note string, price double, part string")
    sinks.create_table(df, name, ["part"], path=f"{workdir}/{name}")
    return name


def rows(spark, name):
    return sorted(map(str, map(tuple, spark.table(name).orderBy("id").collect())))


def sync(spark, name, schema):
    from pyspark.sql.types import StructType

    before = sorted(spark.table(name).inputFiles())
    sinks.sync_all_columns(spark, name, StructType.fromDDL(schema))
    return sorted(spark.table(name).inputFiles()) == before


def test_a_drop_leaves_the_files_and_a_name_that_returns_is_empty(spark, table):
    assert sync(spark, table, "id int, more bigint, price double, part string")
    assert rows(spark, table) == ["(1, None, 1.5, 'x y')", "(2, None, 2.5, None)"]
    sinks.append(spark.createDataFrame([(3, 7, 3.5, "x y")], "id int, more bigint, price double, part string"), table)
    assert rows(spark, table)[2] == "(3, 7, 3.5, 'x y')"
    # note was dropped and comes again: the old rows' values must not
    assert not sync(spark, table, "id int, note string, more bigint, price double, part string")
    assert rows(spark, table) == ["(1, None, None, 1.5, 'x y')", "(2, None, None, 2.5, None)", "(3, None, 7, 3.5, 'x y')"]
    assert sync(spark, table, "id int, note string, more bigint, part string")
    assert sinks.partition_columns(spark, table) == ["part"] and len(rows(spark, table)) == 3


def test_a_new_type_and_a_dropped_partition_column_rewrite(spark, table):
    assert not sync(spark, table, "id string, price double, part string")
    assert rows(spark, table) == ["('1', 1.5, 'x y')", "('2', 2.5, None)"]
    assert not sync(spark, table, "id string, price double")
    assert rows(spark, table) == ["('1', 1.5)", "('2', 2.5)"] and sinks.partition_columns(spark, table) == []


def test_a_managed_table_is_rewritten(spark):
    name = f"managed_{uuid.uuid4().hex[:8]}"
    sinks.create_table(spark.createDataFrame([(1, "a")], "id int, note string"), name)
    assert not sync(spark, name, "id int")
    assert rows(spark, name) == ["(1,)"]
    spark.sql(f"DROP TABLE {name}")
