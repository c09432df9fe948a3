"""Exact dedup and the Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from brute import components_of, shingle_set

from paddock.llm import block_naming, jaccard_join, words

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def near_copies(seed=3):
    """Texts with copies at many distances, shared passages, short, empty and null ones."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    rows, texts = [], []
    for _ in range(60):
        words_ = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 5, 20, 60, 200, 600]))]
        if rnd.random() < 0.4:
            words_ = passage + words_
        texts.append(" ".join(words_))
    base = [rnd.choice(vocabulary) for _ in range(150)]
    for _ in range(150):
        words_ = list(base)
        for _ in range(rnd.randint(0, 10)):
            words_[rnd.randrange(len(words_))] = rnd.choice(vocabulary)
        texts.append(" ".join(words_))
    for t in list(texts[:60]):
        words_ = t.split()
        for _ in range(rnd.randint(0, max(1, len(words_) // 25))):
            words_[rnd.randrange(len(words_))] = rnd.choice(vocabulary)
        texts.append("\t\n".join(words_).upper())
    texts += ["", None, " \n", "a", "A", "a b", "A  b", "ä Ä", "Ä Ä"]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (3, 60)])
def test_components_equal_brute_force(spark, width, percent):
    rows = near_copies()
    got = jaccard_join.jaccard_join(spark, frame(spark, rows), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(rows, width, percent)
    assert len(got) == len(rows)


def test_small_parts_and_frequent_classes_keep_all_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART", 16)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 1)
    rows = near_copies(7)
    got = jaccard_join.jaccard_join(spark, frame(spark, rows), 3, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(rows, 3, 90)


def test_query_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = jaccard_join.jaccard_join(spark, docs).collect()
    want = components_of([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 3, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_signatures_survive_any_allowed_loss():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 10, 1 << jaccard_join.COUNT_BITS)
    for size in (1, 2, 7, 40, 300):
        s = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        bucket = len(s).bit_length()
        mine = set(jaccard_join.signatures(s, counts, 4.0, 80, bucket).tolist())
        for _ in range(40):
            lost = len(s) - int(jaccard_join.least_overlap(len(s), 80))
            other = np.sort(rng.permutation(s)[lost:])
            if 100 * len(other) >= 80 * len(s):
                theirs = {x for b in jaccard_join.buckets(len(other), 80) for x in jaccard_join.signatures(other, counts, 4.0, 80, b).tolist()}
                assert mine & theirs


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts = ["", None, "a", "  The the\tTHE\n", "Ä ä É é", "x" * 9000 + " y", "a,b c-d"]
    got = {i: h.tolist() for i, h in words.documents(pa.array(texts), words.SPACES)}
    for i, t in enumerate(texts):
        assert got[i] == [words.word_hash(w) for w in (t or "").encode().lower().split()]
    cut = {i: h.tolist() for i, h in words.documents(pa.array(texts), words.LETTERS)}
    assert cut[4] == [words.word_hash(w.encode()) for w in "ä ä é é".split()]
    assert cut[6] == [words.word_hash(w) for w in (b"a", b"b", b"c", b"d")]


def test_long_texts_are_cut_into_pieces_without_a_change(monkeypatch):
    import pyarrow as pa

    text = " ".join(f"w{i % 97}" for i in range(5000)) + "z" * 3000
    whole = [h.tolist() for _, h in words.documents(pa.array([text]), words.SPACES)]
    monkeypatch.setattr(words, "BYTES_AT_ONCE", 500)
    assert [h.tolist() for _, h in words.documents(pa.array([text, "a b"]), words.SPACES)][0] == whole[0]


def brute_dedup(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), d))
    out = {}
    for body, members in groups.items():
        keep = min(members)[1]
        for _, d in members:
            out[d] = (keep, len(members), d == keep, hashlib.sha256(body.encode()).hexdigest())
    return out


@pytest.mark.parametrize("block", [3, 16, 4096])
def test_exact_dedup(spark, monkeypatch, block):
    rnd = random.Random(block)
    rows = [(i, "".join(rnd.choice("aé \n") for _ in range(rnd.choice([0, 1, 3, 7, 12, 50])))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "a" * 5000), (1003, "a " * 5000), (1004, "a" * 5001), (1005, " a")]
    monkeypatch.setattr(block_naming, "BLOCK_BYTES", block)
    rows_ = block_naming.common.row_ids(spark, frame(spark, rows))
    got = block_naming.decisions(spark, rows_, block).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == brute_dedup(rows)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "a b", "x"), (1, "a b", "y"), (None, "ab", "z"), (2, "c", None), (2, None, "n")]
    docs = frame(spark, rows, "doc_id bigint, text string, RID string")
    got = block_naming.exact_dedup(spark, docs).collect()
    assert sorted((r.keep_id, r.group_size, r.kept) for r in got) == [(1, 3, False), (1, 3, False), (1, 3, True), (2, 1, True), (2, 1, True)]
    left = block_naming.drop_copies(spark, docs)
    assert left.columns == docs.columns and left.count() == 3
    near = jaccard_join.one_of_each(spark, docs)
    assert near.columns == docs.columns and near.count() == 4
    assert jaccard_join.jaccard_join(spark, docs).count() == 5


def test_empty_tables(spark):
    none = frame(spark, [])
    assert block_naming.exact_dedup(spark, none).count() == 0
    assert jaccard_join.jaccard_join(spark, none).count() == 0
