"""The registered queries of this subpackage: every operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paddock.session import scratch_path

from . import (
    block_naming,
    bpe_automaton,
    decontamination,
    fill_in_middle,
    jaccard_join,
    language_id,
    quality,
    sharding,
    token_files,
    topk_search,
    toxicity,
    url_filter,
    vector_codes,
)
from .common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.bpe_round_trip(table(spark, sf_dir, "documents"), WORD_BPE)


def op2_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(spark, table(spark, sf_dir, "documents"), shards=8)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(spark, table(spark, sf_dir, "documents"), width=3, percent=90)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(spark, table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"), WORD_BPE)


#: The rules that op 6 judges by.
URL_RULES = [
    url_filter.rule("org/", "allow"),
    url_filter.rule("example.org/es/", "block"),
    url_filter.rule("example.org/en/1", "block"),
    url_filter.rule("com/fr/", "allow"),
    url_filter.rule("com/de/", "block"),
]


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(spark, table(spark, sf_dir, "pages"), URL_RULES)


def op7_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_dedup(spark, table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(spark, table(spark, sf_dir, "documents"))


def op11_rank_index_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op12_sorted_list_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(spark, table(spark, sf_dir, "embeddings"), modulus=100, k=10, factor=1024)


def op13_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(spark, table(spark, sf_dir, "embeddings"), positions=16, entries=64, rounds=2, factor=256)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe_automaton,
        op2_segment_toxicity,
        op3_minimax_sharding,
        op4_jaccard_join,
        op5_token_files,
        op6_url_rules,
        op7_block_naming,
        op8_decontamination,
        op9_ordinal_quality,
        op10_language_id,
        op11_rank_index_fim,
        op12_sorted_list_topk,
        op13_dual_tree_codes,
    )
}

#: Op 13: each part's nearest entry, as distance * 64 + index, and the codebook that follows from it.
_NEAREST = """
            SELECT p.r, p.pos, min(((x[1] - y[1]) * (x[1] - y[1]) + (x[2] - y[2]) * (x[2] - y[2])
                                    + (x[3] - y[3]) * (x[3] - y[3]) + (x[4] - y[4]) * (x[4] - y[4])) * 64 + c) AS m
            FROM p JOIN {book} b ON b.pos = p.pos GROUP BY p.r, p.pos"""
_UPDATED = """
            SELECT b.pos, b.c, coalesce(u.y, b.y) AS y FROM {book} b LEFT JOIN (
                SELECT a.pos, a.m % 64 AS c, [CAST(floor(sum(x[1]) / count(*)) AS BIGINT), CAST(floor(sum(x[2]) / count(*)) AS BIGINT),
                       CAST(floor(sum(x[3]) / count(*)) AS BIGINT), CAST(floor(sum(x[4]) / count(*)) AS BIGINT)] AS y
                FROM {near} a JOIN p ON p.r = a.r AND p.pos = a.pos GROUP BY a.pos, a.m % 64) u ON u.pos = b.pos AND u.c = b.c"""

ORACLE_SQL: dict[str, str] = {
    "op6_url_rules": r"""
        WITH rules(host, path, verdict) AS (
            VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                   ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        cut AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
            FROM cut)
        SELECT p.page_id, p.host, p.path,
               (SELECT r.host || r.path FROM rules r
                WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
                ORDER BY length(r.host || r.path) DESC LIMIT 1) AS rule,
               coalesce((SELECT r.verdict FROM rules r
                WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
                ORDER BY length(r.host || r.path) DESC LIMIT 1), 'allow') AS verdict
        FROM parts p
    """,
    "op7_block_naming": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS kept,
               sha256(body) AS text_sha256
        FROM t
    """,
    "op11_rank_index_fim": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents),
        d AS (
            SELECT doc_id, text, n,
                   CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
                   CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4
            FROM t),
        f AS (
            SELECT doc_id, text, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
                   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
                        WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM d),
        o AS (
            SELECT doc_id, text, n, form, a, b, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle,
                   substr(text, b + 1) AS suffix
            FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM o
    """,
    "op12_sorted_list_topk": r"""
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.r <> q.r),
        k AS (
            SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s)
        SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 10
    """,
    "op13_dual_tree_codes": f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (SELECT r, pos, e[pos * 4 + 1 : pos * 4 + 4] AS x FROM v, range(16) t(pos)),
        b0 AS MATERIALIZED (SELECT pos, r - 1 AS c, x AS y FROM p WHERE r <= 64),
        a0 AS MATERIALIZED ({_NEAREST.format(book="b0")}),
        b1 AS MATERIALIZED ({_UPDATED.format(book="b0", near="a0")}),
        a1 AS MATERIALIZED ({_NEAREST.format(book="b1")}),
        b2 AS MATERIALIZED ({_UPDATED.format(book="b1", near="a1")}),
        a2 AS MATERIALIZED ({_NEAREST.format(book="b2")}),
        coded AS (
            SELECT v.vec_id, v.label, string_agg(printf('%02x', a2.m % 64), '' ORDER BY a2.pos) AS code, CAST(sum(a2.m // 64) AS BIGINT) AS error
            FROM v JOIN a2 ON a2.r = v.r GROUP BY v.r, v.vec_id, v.label)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY pos, c)) FROM b2) AS codebooks_sha256
        FROM coded
    """,
}
