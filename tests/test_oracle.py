"""Every registered query against its DuckDB oracle on the small fixture."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as ent
from conftest import SF_SMALL
from paddock.plans import registry
from scripts.oracle_check import TABLES, _rows

ORACLE = ent.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    missing = sorted(set(registry.QUERIES) - set(ORACLE))
    assert missing == []


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = _rows([tuple(r) for r in df.collect()], cols)
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert got == _rows(cur.fetchall(), dcols)


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.columns == ["team_name", "full_name", "location", "date", "average_speed"]
    assert df.count() > 0
