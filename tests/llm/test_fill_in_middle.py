"""Fill-in-middle: the rank index against counting, the outputs against plain slicing."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from paddock.llm import fill_in_middle as fim

SCHEMA = "doc_id bigint, text string"


def plain(doc_id, text):
    """The whole transformation on a Python string."""
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def odd_texts():
    rnd = random.Random(3)
    letters = ["a", "é", "中", "😀", "<", "S", ">", "<S", "M>", "\0", "\n"]
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    return [*made, None, "", "x", "<P>", "a<M>b", "é" * 50_000, "a中" * 200_000, ("word " * 30 + "ж" * 40) * 2000, "́", "﻿"]


def test_outputs_equal_plain_slicing(spark):
    rows = list(enumerate(odd_texts())) * 2 + [(None, "no id"), (None, None), (-5, "negative id"), (2**63 - 1, "largest"), (-(2**63), "least")]
    got = fim.fill_in_middle(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(plain(*r)) for r in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_text_is_rebuilt_from_output_and_form(spark):
    rows = list(enumerate(odd_texts()))
    for r in fim.digests(spark.createDataFrame(rows, SCHEMA)).collect():
        want = plain(*rows[r.doc_id])
        assert r.output_sha256 == hashlib.sha256(want[-1].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((rows[r.doc_id][1] or "").encode()).hexdigest()


def test_other_columns_other_ids_and_empty_tables(spark):
    rows = [("k1", "some text here", 5, 7), ("k2", None, 6, 8), ("k1", "some text here", 5, 7)]
    df = spark.createDataFrame(rows, "key string, body string, doc_id int, n long")
    got = fim.fill_in_middle(df, "key", "body").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(plain(k, t)) for k, t, _, _ in rows)
    clash = spark.createDataFrame([(1, "abc", "x", "y")], "doc_id long, text string, output string, draw string")
    assert [tuple(r) for r in fim.fill_in_middle(clash).collect()] == [plain(1, "abc")]
    assert fim.digests(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("error", [0, 1, 7, 120])
def test_index_is_exact_and_its_lines_stay_within_the_error(error):
    rnd = random.Random(error)
    for size in (0, 1, 2, 3, 50, 4000):
        text = "".join(rnd.choice("aaaaé中😀"[: rnd.randint(1, 7)]) for _ in range(size))
        want = np.cumsum([0, *(len(c.encode()) for c in text)])
        data = np.frombuffer(text.encode(), np.uint8)
        for block in (1, 64, 1 << 20):
            index = fim.RankIndex(data, block, error)
            assert (index[np.arange(size + 1)] == want).all()
            assert np.abs(index.rest.astype(int)).max() <= error + 1
    steady = fim.RankIndex(np.frombuffer(("word жжж " * 50_000).encode(), np.uint8), error=120)
    assert len(steady.starts) == 1  # one line holds a whole text of even mixture
