"""Vector codes: the dual-tree descent against all distances, the whole operator against plain Lloyd rounds."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from paddock.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, positions=16, entries=64, rounds=2, factor=256):
    kept = [(i, [math.floor(factor * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(first[0][1])
    width = -(-max(size, 1) // positions)
    kept = [(i, v + [0] * (width * positions - size), lab) for i, v, lab in kept if len(v) == size]
    first = [v + [0] * (width * positions - size) for _, v, _ in first if len(v) == size][:entries]

    def part(v, p):
        return v[p * width : (p + 1) * width]

    books = [[part(v, p) for v in first] for p in range(positions)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(part(v, p), e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(positions):
            to = [[] for _ in books[p]]
            for _, v, _ in kept:
                to[nearest(v, p)[1]].append(part(v, p))
            new.append([[sum(c) // len(got) for c in zip(*got)] if got else e for e, got in zip(books[p], to)])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(i, [nearest(v, p) for p in range(positions)], lab) for i, v, lab in kept]
    total = {}
    for _, near, lab in found:
        total[lab] = total.get(lab, 0) + sum(d for d, _ in near)
    return sorted(((i, "".join(f"{c:02x}" for _, c in near), sum(d for d, _ in near), total[lab], digest) for i, near, lab in found), key=str)


def coded(spark, rows, schema=SCHEMA, **given):
    return sorted(map(tuple, vc.vector_codes(spark, spark.createDataFrame(rows, schema), **given).collect()), key=str)


def made(rnd, n, dim):
    centres = [[rnd.gauss(0, 0.2) for _ in range(dim)] for _ in range(9)]
    return [[x + rnd.gauss(0, 0.05) for x in rnd.choice(centres)] for _ in range(n)]


def test_equals_plain_rounds(spark):
    rnd = random.Random(13)
    rows = [(i, v, rnd.choice([1, 2, 3, None])) for i, v in enumerate(made(rnd, 400, 32))]
    rnd.shuffle(rows)
    assert coded(spark, rows) == brute(rows)
    assert coded(spark, rows, positions=4, entries=5, rounds=3, factor=16) == brute(rows, 4, 5, 3, 16)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vc, "HOT_LABELS", 3)  # one label is frequent, the others are not
    monkeypatch.setattr(vc, "BLOCK_ROWS", 64)
    rnd = random.Random(2)
    same = [0.5, -0.25, 0.125, 0.0, 0.75, -1.0]  # a length that four parts don't divide
    rows = [(i, same, 7) for i in range(200)] + [(i, [rnd.uniform(-1, 1) for _ in same], i % 40) for i in range(200, 300)]
    rows += [(3, same, 7), (3, [0.0] * 6, None), (None, same, None), (-5, [1.0] * 6, 1), (-5, [-1.0] * 6, 1)]
    rows += [(900, None, 1), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (902, [math.nan] * 6, 1), (903, [math.inf] + [0.0] * 5, 2)]
    rows += [(904, [1.0, 2.0], 3), (905, [], 4)]
    assert coded(spark, rows, positions=4, entries=8) == brute(rows, 4, 8)


def test_few_rows_other_columns_and_empty_tables(spark):
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, 1), (2, [math.nan], 1)]) == []
    assert coded(spark, [(4, [0.5, 0.25], None)], positions=2) == brute([(4, [0.5, 0.25], None)], 2)
    assert coded(spark, [(4, [], 1), (5, [], 1)], positions=2) == brute([(4, [], 1), (5, [], 1)], 2)
    rows = [(1, [0.5, 0.25], "a", "x", 3), (2, [0.25, 0.5], "b", "y", 4)]
    got = coded(spark, rows, "vec_id int, embedding array<float>, label string, code string, error long", positions=2)
    assert got == brute([r[:3] for r in rows], 2)


@pytest.mark.parametrize("spread", [2, 6, 200])
def test_descent_equals_all_distances(spread):
    rnd = np.random.default_rng(spread)
    for trial in range(40):
        n, positions, width, count = (int(rnd.integers(1, top)) for top in (300, 5, 5, 70))
        points, entries = (rnd.integers(-spread, spread, (positions, k, width)) for k in (n, count))
        if trial % 3 == 0:  # many equal parts, and equal entries
            points[:, n // 2 :], entries[:, count // 2 :] = points[:, :1], entries[:, :1]
        tree = vc.Tree(n, vc.LEAF)
        places = tree.order(points)
        assert (np.sort(places, axis=1) == np.arange(n)).all()
        points = np.take_along_axis(points, places[:, :, None], axis=1)
        low, high, sums, book = *vc.boxes(tree, points), tree.levels(points, np.add), vc.EntryTree(entries)
        distance = ((points[:, :, None, :] - entries[:, None, :, :]) ** 2).sum(-1)
        code, error = vc.nearest(tree, points, low, high, book)
        assert (code == distance.argmin(-1)).all() and (error == distance.min(-1)).all()
        total = vc.part_sums(tree, points, low, high, sums, book).reshape(positions, count, width + 1)
        for p in range(positions):
            for c in range(count):
                own = points[p][code[p] == c]
                assert (total[p, c, :-1] == own.sum(0)).all() and total[p, c, -1] == len(own)


def test_clustered_parts_are_assigned_whole():
    rnd = np.random.default_rng(1)
    entries = rnd.integers(-4000, 4000, (2, 16, 4))
    points = entries[:, rnd.integers(0, 16, 2000)] + rnd.integers(-20, 20, (2, 2000, 4))
    tree = vc.Tree(2000, vc.LEAF)
    points = np.take_along_axis(points, tree.order(points)[:, :, None], axis=1)
    whole, single = vc.assign(tree, points, *vc.boxes(tree, points), vc.EntryTree(entries))
    assert sum(len(s[0]) for s in single) < 0.2 * points.shape[0] * points.shape[1]
