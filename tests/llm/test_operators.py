"""The other operators against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import itertools
import random
import struct
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as ent
import corpus_pipeline
from paddock.llm import (
    bpe_automaton, decontamination, language_id, ngrams, quality, queries, sharding, token_files, toxicity, url_filter,
)
from paddock.session import scratch_path
from scripts.oracle_check import _rows

SF = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.WORD_BPE)


def odd_texts():
    rnd = random.Random(0)
    letters = "aab bc's 'll 12 %%$# éÉñŉΣσİ\u0301 \x1c\x1f ﬁ中文字 don't I'VE \x85 aaaaaa <|endoftext|>x<|startoftext|>hahaha"
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    made += ["".join(rnd.choice("inthead") for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    return [*made, None, "", " \n", "x" * 20_000, "ab " * 20_000, "".join(map(chr, range(256))), "a".join(map(chr, range(256)))]


def test_bpe_equals_the_library(spark, reference):
    rows = list(enumerate(odd_texts()))
    got = bpe_automaton.bpe_round_trip(frame(spark, rows), queries.WORD_BPE).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = reference.encode(rows[r.doc_id][1] or "", add_special_tokens=False).ids
        decoded = reference.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_plain_output(spark, reference):
    got = bpe_automaton.bpe_tokens(frame(spark, [(1, "Hello there"), (1, None)]), queries.WORD_BPE).collect()
    assert sorted(r.ids for r in got) == [[], reference.encode("hello there", add_special_tokens=False).ids]


def test_automaton_equals_merging_by_rank():
    """Every word over a small alphabet, with merges that overlap and repeat a letter."""
    merges = [("a", "a"), ("a", "b"), ("aa", "a"), ("ab", "a</w>"), ("b", "a"), ("aa", "ba"), ("b", "b</w>")]
    base = ["a", "b", "a</w>", "b</w>"]
    vocab = {s: i for i, s in enumerate([*base, *dict.fromkeys(u + v for u, v in merges)])}
    machine = bpe_automaton.Automaton(vocab, merges, "</w>")
    rank = {m: i for i, m in enumerate(merges)}
    for n in range(1, 10):
        for word in itertools.product("ab", repeat=n):
            parts = [*word[:-1], word[-1] + "</w>"]
            while True:
                found = [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]
                if not found:
                    break
                _, i = min(found)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert [machine.label[t] for t in machine.encode("".join(word).encode())] == parts
    with pytest.raises(ValueError):
        bpe_automaton.Automaton(vocab, merges[1:] + merges[:1], "</w>")


def test_token_files(spark, reference):
    rows = [(i * 7 % 641, t) for i, t in enumerate(odd_texts())]
    path = scratch_path(spark, "test-token-files")
    token_files.BLOCK_DOCUMENTS, kept = 50, token_files.BLOCK_DOCUMENTS
    try:
        got = token_files.token_files(spark, frame(spark, rows), path, queries.WORD_BPE).collect()
    finally:
        token_files.BLOCK_DOCUMENTS = kept
    start, want = 0, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        ids = [*reference.encode(t or "", add_special_tokens=False).ids, 1]
        want[d] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)), ids)
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == {d: w[:3] for d, w in want.items()}
    some = [rows[5][0], rows[77][0], 10**9]
    found = token_files.fetch(spark, path, some).collect()
    assert {r.doc_id: r.ids for r in found} == {d: want[d][3] for d in some[:2]}


def test_token_files_small_tables(spark):
    schema = "doc_id bigint, text string, Text string"
    none = token_files.token_files(spark, frame(spark, [], schema), scratch_path(spark, "t"), queries.WORD_BPE)
    assert none.count() == 0
    rows = [(None, "a", "x"), (3, "b c", "x"), (3, None, "y"), (3, "b c", "x")]
    got = token_files.token_files(spark, frame(spark, rows, schema), scratch_path(spark, "t"), queries.WORD_BPE).collect()
    assert sorted(r.n_tokens for r in got) == [1, 2, 3, 3] and sorted(r.start for r in got)[0] == 0
    assert min(got, key=lambda r: r.start).doc_id is None


def brute_capacity(sizes, shards):
    """Smallest largest run by trying every capacity that a run can have."""
    totals = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})

    def fits(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > capacity:
                return False
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used <= shards

    return next(c for c in totals if fits(c))


@pytest.mark.parametrize("n,hot", [(5, 0), (60, 0), (300, 0), (200, 150)])
def test_shards(spark, monkeypatch, n, hot):
    monkeypatch.setattr(sharding, "FIRST", 1)
    monkeypatch.setattr(sharding, "FURTHER", 1)
    rnd = random.Random(n)
    rows = [(i, "h" * 40 if i < hot else "".join(rnd.choice("aé") for _ in range(rnd.randint(0, 30)))) for i in range(n)]
    rows += [(n, None), (n + 1, "")]
    got = sharding.shard(spark, frame(spark, rows), 8).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    groups = {}
    for d, t in rows:
        body = (t or "").encode()
        groups.setdefault(hashlib.md5(body).hexdigest(), []).append(len(body) + 1)
    sizes = [sum(groups[k]) for k in sorted(groups)]
    loads, of, slots = [0] * 8, {}, {}
    for r in got:
        body = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, zlib.crc32(body), "bytes", None)
        loads[r.shard] += r.size
        assert of.setdefault(body, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
    assert max(loads) == brute_capacity(sizes, 8) == got[0].capacity
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_documents(spark):
    got = queries.op3_minimax_sharding(spark, MIDDLE).collect()
    loads = [sum(r.size for r in got if r.shard == k) for k in range(8)]
    assert len(got) == 1000 and max(loads) < 1.15 * sum(loads) / 8
    assert sharding.shard(spark, frame(spark, [])).count() == 0


def test_url_rules(spark):
    rules = [*queries.URL_RULES, url_filter.rule("a.b/", "block")]
    urls = [
        "http://Example.ORG/es/1", "http://m.example.org/en/1?x", "http://example.org/en/12", "http://example.org/en/2", "http://org/", "http://org",
        "http://xorg/", "http://www.example.com/fr/x#y", "http://com/de/", "http://com/de", "example.org/es/", None, "", "a://b://c/", "x://a.b/\n", "x://z.a.b/q",
        "x://com?/de/", "x:///es/", "http://example.org/es", "http://example.com/DE/", "http://example.org:80/es/",
    ]
    got = {r.page_id: r for r in url_filter.url_filter(spark, frame(spark, list(enumerate(urls)), "page_id bigint, url string"), rules).collect()}
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[: min([k for k in map(tail.find, "?#") if k >= 0], default=len(tail))]
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        want = (host, path, best.name if best else None, best.verdict if best else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want, url
    assert url_filter.url_filter(spark, frame(spark, [], "page_id int, url string"), rules).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = ent.queries()[name](spark, SF)
    got = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(got.fetchall(), columns)


def edit_distance_to_best_run(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        last, row = row, [i] + [0] * len(text)
        for j, v in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (w != v))
    return min(row)


def test_edit_search_equals_dynamic_programming():
    rng = np.random.default_rng(0)
    for _ in range(200):
        item, text = rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64), rng.integers(0, 4, rng.integers(0, 30)).astype(np.uint64)
        want = edit_distance_to_best_run(item.tolist(), text.tolist())
        got = decontamination.edit_search(item, text, len(item) - 1)
        assert (got[0] if got else len(item)) == want


def test_leaks_reach_the_recall_of_brute_force(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([8, 12, 20, 40])))) for i in range(30)] + [(98, "too short"), (99, None)]
    docs = []
    for d in range(200):
        body = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 5, 60, 300]))]
        passage = items[rnd.randrange(30)][1].split()
        for _ in range(rnd.randint(0, len(passage) // 4)):
            k = rnd.randrange(len(passage))
            passage[k : k + 1] = rnd.choice([[], [rnd.choice(vocabulary)], [passage[k], rnd.choice(vocabulary)]])
            passage = passage or ["x"]
        at = rnd.randint(0, len(body))
        docs.append((d, (", ".join(body[:at] + passage + body[at:])).upper() if d % 3 else " ".join(body)))
    docs += [(1000, None), (1001, "")]
    got = decontamination.leaks(spark, frame(spark, docs), frame(spark, items, "item_id bigint, text string")).collect()
    found = {(r.doc_id, r.item_id): r.edits for r in got}
    want = {}
    for d, t in docs:
        for i, item in items[:30]:
            w = item.split()
            e = edit_distance_to_best_run(w, (t or "").lower().replace(",", "").split())
            if e <= len(w) // 5:
                want[(d, i)] = e
    assert set(found) <= set(want) and all(found[k] >= want[k] for k in found)
    assert len(found) >= 0.95 * len(want) and len(want) > 60
    exact = [k for k, e in want.items() if e == 0]
    assert exact and all(k in found for k in exact)
    assert decontamination.leaks(spark, frame(spark, []), frame(spark, items, "item_id bigint, text string")).count() == 0
    assert decontamination.leaks(spark, frame(spark, docs), frame(spark, [], "item_id bigint, text string")).count() == 0


def test_leaks_with_clustered_head_and_tail_edits_are_all_found(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(n))) for i, n in enumerate([8, 11, 15, 40, 40, 60, 150])]
    docs = []
    for _, item in items:
        w = item.split()
        k, half = len(w) // 5, len(w) // 2
        body = [rnd.choice(vocabulary) for _ in range(30)]
        places = set(rnd.sample(range(half), k))
        new = [rnd.choice(vocabulary) for _ in range(k)]
        docs += [
            w[k:] + body, body + w[:-k], w[k:], w[:-k], body + w[k:] + body,
            body + [v for j, v in enumerate(w) if j not in places] + body,
            body + w[:3] + new + w[3:] + body, new + w + body, body + w[:half] + w[half + k :],
            body + new + w[k:] + body, body + w[:-k] + new + body, body + w[k + 1 :], w[: -k - 1] + ["zz"] + body,
        ]
    docs = [(d, " ".join(t)) for d, t in enumerate(docs)]
    got = decontamination.leaks(spark, frame(spark, docs), frame(spark, items, "item_id bigint, text string")).collect()
    want = {}
    for d, t in docs:
        for i, item in items:
            e = edit_distance_to_best_run(item.split(), t.split())
            if e <= len(item.split()) // 5:
                want[(d, i)] = e
    assert len(want) > 75 and {(r.doc_id, r.item_id): r.edits for r in got} == want


def test_short_items_and_scripts_without_blanks_leak(spark):
    items = [
        (0, "Who wrote Hamlet?"), (1, "seven"), (2, "one two three four five six seven"), (3, "..."),
        (4, "长城是中国古代的军事防御工程，全长超过两万公里。"), (5, "日本の首都はどこですか"), (6, "เมืองหลวงของประเทศไทยคืออะไร"),
    ]
    docs = [
        (0, "He asked: who wrote HAMLET, and why"), (1, "who wrote about hamlet"), (2, "one two three four six seven"),
        (3, "one two three four five six seven"), (4, "大家知道,长城是中国古代的军事防御工程全长超过三万公里吧"), (5, "长城在中国"),
        (6, "質問:日本の首都はどこですか?はい"), (7, "คำถามเมืองหลวงของประเทศไทยคืออะไรครับ"), (8, None), (9, "..."), (10, "日本の首都"),
    ]
    got = decontamination.leaks(spark, frame(spark, docs), frame(spark, items, "item_id bigint, text string")).collect()
    # by the scripts' characters, item 4 has 22 words
    assert {(r.doc_id, r.item_id): (r.edits, r.n_words) for r in got} == {
        (0, 0): (0, 3), (2, 1): (0, 1), (3, 1): (0, 1), (3, 2): (0, 7), (4, 4): (1, 22), (6, 5): (0, 11), (7, 6): (0, 28),
    }


def test_copies_of_an_item_text_reach_the_driver_once(spark, monkeypatch):
    kept = []
    block = decontamination._block

    def counted(spark, rows, items, percent):
        kept.append(items.count())
        return block(spark, rows, items, percent)

    monkeypatch.setattr(decontamination, "_block", counted)
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 100)
    texts = [" ".join(f"{c}{i}" for i in range(12)) for c in "abcdefgh"]
    items = [(i, texts[0]) for i in range(500)] + [(500 + i, t) for i, t in enumerate(texts)]
    docs = [(0, f"x {texts[0]} y"), (1, f"x {texts[3]} y"), (2, "x y")]
    got = decontamination.leaks(spark, frame(spark, docs), frame(spark, items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(0, i) for i in range(501)] + [(1, 503)]
    assert sum(kept) == len(texts) and len(kept) > 1
    assert [r.doc_id for r in decontamination.drop_leaks(spark, frame(spark, docs), frame(spark, items, "item_id bigint, text string")).collect()] == [2]


def test_stretches_by_few_items_at_a_time_are_the_same(monkeypatch):
    rng = np.random.default_rng(4)
    items = [rng.integers(0, 5, n).astype(np.uint64) for n in rng.integers(8, 60, 40)]
    block = decontamination.Items(list(range(40)), items, 20)
    texts = [rng.integers(0, 5, 400).astype(np.uint64) for _ in range(10)]
    whole = [block.search(t) for t in texts]
    monkeypatch.setattr(decontamination, "PLACES_AT_ONCE", 1)
    assert [block.search(t) for t in texts] == whole and any(whole)
    for t, found in zip(texts, whole):
        exact = {i: e for i, item in enumerate(items) if (e := edit_distance_to_best_run(item.tolist(), t.tolist())) <= len(item) // 5}
        assert {i: e for i, e, _, _ in found} == exact


def test_dictionary_is_trained_on_all_parts_of_long_documents(spark, monkeypatch):
    seen = []
    train = token_files.train
    monkeypatch.setattr(token_files, "train", lambda samples: seen.extend(samples) or train(samples))
    docs = [(d, " ".join(f"{part}{i % 97} {d}" for part in ("head", "middle", "tail") for i in range(4000))) for d in range(24)]
    token_files.write(spark, frame(spark, docs), scratch_path(spark, "pieces"), queries.WORD_BPE)
    whole = [token_files.serialised(queries.WORD_BPE, t, 2) for _, t in docs]
    at = [next(w.index(s) / len(w) for w in whole if s in w) for s in seen]
    assert len(seen) == 24 and all(len(s) == token_files.SAMPLE_BYTES for s in seen)
    assert min(at) < 0.33 and any(0.33 < a < 0.67 for a in at) and max(at) > 0.67
    assert token_files.piece(b"ab" * 9, 2) == b"ab" * 9 and token_files.piece(b"", 4) == b""


def test_samples_are_bounded_where_ids_are_null_or_repeated(spark, monkeypatch):
    texts = [f"some words of text number {i} and {i * i}" for i in range(300)]
    for ids in ([None] * 300, [7] * 300, [2] * 200 + list(range(100, 200))):
        docs = frame(spark, list(zip(ids, texts)) + [(None, "the same")] * 200)
        seen = []
        train = token_files.train
        monkeypatch.setattr(token_files, "SAMPLE", 40)
        monkeypatch.setattr(token_files, "train", lambda samples: seen.append(len(samples)) or train(samples))
        token_files.write(spark, docs, scratch_path(spark, "bounded"), queries.WORD_BPE)
        assert 10 <= seen[0] <= 40
        monkeypatch.undo()
    for ids in ([None] * 300, [7] * 300):
        monkeypatch.setattr(language_id, "SAMPLE", 20)
        means = language_id._k_means
        sizes = scratch_path(spark, "sizes")

        def counted(points, k, means=means, sizes=sizes):
            with open(sizes, "a") as f:
                f.write(f"{len(points)}\n")
            return means(points, k)

        monkeypatch.setattr(language_id, "_k_means", counted)
        got = language_id.fit(frame(spark, [(i, t, "en") for i, t in zip(ids, texts)], "doc_id bigint, text string, lang string"))
        assert got.languages and 5 <= int(open(sizes).read()) <= 20
        monkeypatch.undo()
    monkeypatch.setattr(quality, "SAMPLE", 20)
    seen = []
    train_quality = quality.train
    monkeypatch.setattr(quality, "train", lambda places, *rest: seen.append(len(places)) or train_quality(places, *rest))
    graded = frame(spark, [(2 * i, i % 3) for i in range(50)], "doc_id bigint, grade int")
    quality.fit(frame(spark, [(2 * (i % 5), t) for i, t in enumerate(texts)]), graded)
    assert seen[0] <= 5


def test_maximal_segments_equal_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(300):
        score = rng.integers(-3, 4, rng.integers(0, 14)).astype(float)

        def split(lo, hi):
            """The best segment (shortest, then first), then the same to its left and right."""
            spans = [(-score[i:j].sum(), j - i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1) if score[i:j].sum() > 0]
            if not spans:
                return []
            _, _, i, j = min(spans)
            return [*split(lo, i), (-min(spans)[0]), *split(j, hi)]

        assert [t for *_, t in toxicity.maximal_segments(score)] == pytest.approx(split(0, len(score)))


def test_long_runs_of_segments_take_linear_time():
    score = np.tile([1.0, -1.0], 200_000)
    assert len(toxicity.maximal_segments(score)) == 200_000


def held_out_rows(spark, df, sf=MIDDLE):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return df.where("held_out").join(docs, "doc_id").join(labels, "doc_id", "left").collect()


def test_language_on_held_out_documents(spark):
    rows = held_out_rows(spark, queries.op10_language_id(spark, MIDDLE))
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows) and not any(r.rejected for r in rows)


def test_language_of_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(None, None, None), (10**6, "", "en"), (10**6 + 1, "123 ++", None), (10**6 + 1, "ПРИВЕТ мир " * 40, None), (10**6 + 2, "the of and thing", None)]
    got = language_id.language_id(spark, docs.unionByName(frame(spark, odd, "doc_id bigint, text string, lang string"))).where("doc_id is null or doc_id >= 1000000").collect()
    assert sorted(r.lang_pred for r in got)[-3:] == ["und"] * 3
    assert sum(r.rejected for r in got) == 4 and all(r.score == 0 for r in got if r.lang_pred == "und")
    nothing = language_id.language_id(spark, frame(spark, [(1, "abc", None)], "doc_id bigint, text string, lang string")).collect()
    assert nothing[0].lang_pred == "und"
    assert language_id.language_id(spark, frame(spark, [], "doc_id bigint, text string, lang string")).count() == 0


def test_quality_on_held_out_documents(spark):
    rows = [r for r in held_out_rows(spark, queries.op9_ordinal_quality(spark, MIDDLE)) if r.quality is not None]
    assert np.mean([r.selected == (r.quality == 1) for r in rows]) > 0.9
    assert all(0 <= r.p_best <= r.p_good <= 1 and abs(r.expected_grade - r.p_good - r.p_best) < 1e-9 for r in rows)


def test_ordinal_fit_orders_three_grades():
    rng = np.random.default_rng(0)
    at = [np.array([k, 10]) for k in rng.integers(0, 3, 600)]
    grades = np.array([min(2, max(0, a[0] + rng.integers(-1, 2) * (rng.random() < 0.2))) for a in at])
    model = quality.train(at, [np.ones(2, np.float32)] * 600, grades, 2)
    tails = [quality._sigmoid(model.weights[k] + model.weights[10] - model.thresholds) for k in range(3)]
    assert model.thresholds[0] < model.thresholds[1]
    assert [int((t > 0.5).sum()) for t in tails] == [0, 1, 2]


def test_toxicity_on_held_out_documents(spark):
    large = "/root/testdata/sf0.1"
    rows = [r for r in held_out_rows(spark, queries.op2_segment_toxicity(spark, large), large) if r.toxic is not None]
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert np.mean([r.predicted for r in clean]) < 0.03
    assert np.mean([r.predicted for r in toxic]) > 0.8


def test_models_with_odd_rows(spark):
    docs = frame(spark, [(1, None), (2, ""), (2, "a fine day"), (None, "x"), (5, "bad " * 500)])
    for labels in ([], [(1, 0, 1), (2, 1, 0), (2, 0, 0), (5, None, None), (None, 1, 1)]):
        labels = frame(spark, labels, "doc_id bigint, quality bigint, toxic bigint")
        assert quality.quality(spark, docs, labels).count() == 5
        got = toxicity.toxicity(spark, docs, labels).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert toxicity.toxic_passages(spark, docs, labels).columns[-1] == "passages"
    none = frame(spark, [])
    assert quality.quality(spark, none, labels).count() == toxicity.toxicity(spark, none, labels).count() == 0


def test_trigrams_of_long_texts_are_counted_whole(monkeypatch):
    text = "Abc def! " * 300
    whole = ngrams.counts(text, 10, False)
    monkeypatch.setattr(ngrams, "PIECE", 100)
    assert (ngrams.counts(text, 10, False) == whole).all() and whole.sum() == len(text)


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "bpe_encoding"]
    docs = corpus_pipeline.table(spark, SF, "documents")
    columns, counts = docs.columns, []
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(spark, step(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(got) == counts[-1] and {r.doc_id for r in got} == {r.doc_id for r in docs.select("doc_id").collect()}
    from brute import components_of

    rows = [(r.doc_id, r.text) for r in corpus_pipeline.table(spark, SF, "documents").select("doc_id", "text").collect()]
    parts = components_of([(d, t) for d, t in rows], 5, 80)
    assert counts[0] == 200 and counts[2] <= len({c for _, c in parts.values()})


def test_pipeline_stages_equal_brute_force(spark):
    from brute import components_of

    def cut(text):
        lower = "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c for c in text or "")
        return "".join(c if not c.isascii() or c.isalnum() else " " for c in lower).split(" ")

    table = corpus_pipeline.table(spark, SF, "documents")
    rows = {r.doc_id: r for r in table.collect()}
    items = [[w for w in cut(r.text) if w] for r in corpus_pipeline.table(spark, SF, "benchmark").collect()]
    some, planted = sorted(rows)[:60], []

    def plant(row, text):
        planted.append((10_000 + len(planted), text, row.lang, row.source, len(text)))

    for n, d in enumerate(some):
        row, w = rows[d], rows[d].text.split(" ")
        if n % 3 == 0:
            plant(row, row.text.replace(" ", "  "))  # a copy by its normalised text
        elif n % 3 == 1:
            plant(row, " ".join([*w, "Ending"]))  # a near copy, where the text is long
        else:
            item = items[n % len(items)]
            plant(row, " ".join(w[:9] + item[len(item) // 6 :] + w[9:]))  # a leak with its head cut off
    docs = table.unionByName(spark.createDataFrame(planted, table.schema))

    word_of = {}

    def leaks(text):
        hashed = np.array([word_of.setdefault(w, len(word_of)) for w in cut(text) if w], np.uint64)
        return any(
            decontamination.edit_search(np.array([word_of.setdefault(w, len(word_of)) for w in item], np.uint64), hashed, len(item) // 5)
            for item in items
        )

    def brute(name, before):
        if name == "exact_dedup":
            best = {}
            for r in before:
                key = "".join((r.text or "").split())
                best[key] = min(best.get(key, (1, 0)), (-len(r.text or ""), r.doc_id))
            return {d for _, d in best.values()}
        if name == "jaccard_join":
            return {root for _, root in components_of([(r.doc_id, r.text) for r in before], 5, 80).values()}
        return {r.doc_id for r in before if not leaks(r.text)}

    dropped = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = corpus_pipeline.stage(spark, step(spark, docs, SF), f"brute-{name}")
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        dropped[name] = len(before) - len(after)
        if name != "language_id":
            assert after == brute(name, before), name
    # every stage has something to drop and something to keep; every text here is one of a known language
    assert dropped["language_id"] == 0 and all(5 <= dropped[n] < 100 for n in ("exact_dedup", "jaccard_join", "decontamination")), dropped
