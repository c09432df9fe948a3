"""Rows that used to crash an operator or to make its result depend on how they were dealt."""

from __future__ import annotations

import random
import struct

import pytest

from paddock.llm import block_naming, bpe_automaton, quality, queries, token_files, toxicity, url_filter


@pytest.mark.parametrize("make", [bpe_automaton.Tokenizer, token_files.LibraryTokenizer])
def test_every_code_point_is_encoded_as_the_library_does(make):
    from tokenizers import Tokenizer

    reference, tok = Tokenizer.from_file(queries.WORD_BPE), make(queries.WORD_BPE)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    size = 400 if make is token_files.LibraryTokenizer else 2000
    step = 1 if make is token_files.LibraryTokenizer else 7  # the automaton shares the cutting, which is what differs
    points = points[::step]
    texts = [" ".join(f"ab{c}cd E{c}́" for c in points[i : i + size]) for i in range(0, len(points), size)]
    for text, got in zip(texts, reference.encode_batch(texts, add_special_tokens=False)):
        assert tok.encode(text) == struct.pack(f"<{len(got.ids)}I", *got.ids), ascii(text[:80])


def test_a_host_with_a_line_feed_is_a_subdomain(spark):
    urls = ["http://a\n.example.org/es/x", "http://a\n.org\n/x", "http://x.org/\n", "http://\nexample.org/es/", None]
    df = spark.createDataFrame(list(enumerate(urls)) * 2, "page_id int, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.url_filter(spark, df, queries.URL_RULES).collect()}
    assert got == {0: ("example.org/es/", "block"), 1: (None, "allow"), 2: ("org/", "allow"), 3: ("org/", "allow"), 4: (None, "allow")}


def test_extreme_and_text_ids_in_exact_dedup(spark):
    least, most = -(2**63), 2**63 - 1
    rows = [(least, "a b"), (most, "ab"), (None, "a  b"), (0, "a\tb"), (least, "zz"), (least, "z z"), (5, None), (least, "")]
    got = block_naming.exact_dedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == sorted([
        (str(least), "None", 4, False), (str(most), "None", 4, False), ("None", "None", 4, True), ("0", "None", 4, False),
        (str(least), str(least), 2, False), (str(least), str(least), 2, True), ("5", str(least), 2, False), (str(least), str(least), 2, True),
    ])
    texts = [("k2", "same"), ("k1", "same"), ("k10", "s a m e"), (None, "other")]
    got = block_naming.exact_dedup(spark, spark.createDataFrame(texts, "doc_id string, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {("k2", "k10", False), ("k1", "k10", False), ("k10", "k10", True), (None, None, True)}


def test_labels_that_disagree_give_one_result_however_they_are_dealt(spark):
    rnd = random.Random(4)
    words = ["good", "bad", "nice", "awful", "fine", "vile", "calm", "rude"]
    docs = [(i, " ".join(rnd.choice(words[i % 2 :: 2]) for _ in range(12))) for i in range(120)]
    labels = [(i, rnd.randint(0, 1), i % 2) for i in range(120)]
    labels += [(i, 1 - q, 1 - t) for i, q, t in labels[::3]]  # a second opinion on every third
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    seen = []
    for parts in (1, 3, 7):
        rnd.shuffle(labels)
        dealt = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").repartition(parts)
        seen.append([
            sorted(map(tuple, toxicity.toxicity(spark, df, dealt).collect())), sorted(map(tuple, quality.quality(spark, df, dealt).collect())),
        ])
    largest = {}
    for i, q, t in labels:
        largest[i] = max(largest.get(i, (0, 0))[0], q), max(largest.get(i, (0, 0))[1], t)
    once = spark.createDataFrame([(i, *v) for i, v in largest.items()], "doc_id bigint, quality int, toxic int")
    assert seen[0][0] == seen[1][0] == seen[2][0] == sorted(map(tuple, toxicity.toxicity(spark, df, once).collect()))
    assert seen[0][1] == seen[1][1] == seen[2][1]
