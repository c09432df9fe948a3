"""Exact top-k search against all inner products."""

from __future__ import annotations

import math
import random

import numpy as np

from paddock.llm import topk_search

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, modulus=100, k=10, factor=1024):
    kept = [(i, [math.floor(factor * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(kept):
        if q is not None and q % modulus == 0:
            scored = [(-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), c is None, c or 0) for b, (c, w) in enumerate(kept) if b != a and len(w) == len(v)]
            out += [(q, rank, None if none else c, -s) for rank, (s, none, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, schema=SCHEMA, **given):
    return sorted(map(tuple, topk_search.search(spark, spark.createDataFrame(rows, schema), **given).collect()), key=str)


def vectors(rnd, n, dim, kinds=12):
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(kinds)]
    return [[x + rnd.gauss(0, 0.4) for x in rnd.choice(centres)] for _ in range(n)]


def test_equals_all_inner_products(spark):
    rnd = random.Random(12)
    rows = list(enumerate(vectors(rnd, 1500, 24)))
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, modulus=500, k=3, factor=64) == brute(rows, 500, 3, 64)


def test_many_blocks_and_units(spark, monkeypatch):
    rnd = random.Random(5)
    rows = list(enumerate(vectors(rnd, 900, 6)))
    for name, value in (("BLOCK_ROWS", 64), ("UNIT_BLOCKS", 2), ("LEAST_PACK", 2)):
        monkeypatch.setattr(topk_search, name, value)
    assert found(spark, rows, modulus=50) == brute(rows, 50)


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rnd = random.Random(7)
    same = [1.0, -0.5, 0.25]
    rows = [(i, same) for i in range(0, 400)]  # one vector holds most of the rows
    rows += [(i, [rnd.choice([-1.0, 0.0, 1.0]) for _ in range(3)]) for i in range(400, 700)]
    rows += [(100, same), (100, [0.0, 0.0, 0.0]), (None, same), (None, same), (-200, [2.0, 0.0, 0.0])]
    rows += [(800, None), (900, [1.0, None, 1.0]), (1000, [1.0, math.nan, 1.0]), (1100, [math.inf, 0.0, 0.0]), (1200, [])]
    rows += [(1300, [1.0, 2.0]), (1301, [1.0, 2.0]), (1400, [0.5]), (1500, []), (1600, [0.0, 0.0])]
    assert found(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(i, [(-1) ** i * 1e12 * i + 0.5, 3.0 * i, 1e14]) for i in range(0, 300, 20)] + [(301, [1e15, -1e15, 0.0])]
    assert found(spark, rows) == brute(rows)


def test_few_rows_other_columns_and_empty_tables(spark):
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []
    rows = [(0, [1.0, 0.0], "a", 1), (1, [0.5, 0.5], "b", 2)]
    schema = "vec_id int, embedding array<float>, v string, query long"
    assert found(spark, rows, schema) == [(0, 1, 1, 1024 * 512)]


def test_bounds_leave_most_rows_out():
    """With a floor, few rows are read to the end."""
    rnd = np.random.default_rng(0)
    matrix = np.floor(1024 * rnd.normal(0, 0.125, (4096, 32)))
    places, terms = topk_search.sorted_lists(matrix)
    levels = terms[:, np.linspace(0, len(matrix) - 1, topk_search.MARKS).astype(int)]
    scores = matrix @ matrix[0]
    floor = np.sort(scores[1:])[-10]
    at, got = topk_search.best_in_block(matrix[0], places.astype(np.intp), terms, levels, 10, floor, 0)
    assert set(np.flatnonzero(scores >= floor)) - {0} <= set(at.tolist()) and (scores[at] == got).all()
    assert 0 not in at and len(at) < 200
