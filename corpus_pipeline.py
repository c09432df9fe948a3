"""The corpus pipeline over ``documents``: STAGES in order, each written and reread.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import block_naming, bpe_automaton, decontamination, jaccard_join, language_id, queries
from paddock.llm.common import stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents far from every known language, or without letters, go (op 10)."""
    return language_id.keep_identified(spark, docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest, then the smallest id (op 7)."""
    return block_naming.drop_copies(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 stays: the smallest id (op 4)."""
    return jaccard_join.one_of_each(spark, docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go (op 8)."""
    return decontamination.drop_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, checked by decoding (op 1)."""
    return bpe_automaton.bpe_round_trip(docs, queries.WORD_BPE)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify),
    ("exact_dedup", dedup),
    ("jaccard_join", near_dedup),
    ("decontamination", decontaminate),
    ("bpe_encoding", encode),
]

#: Language identification and the tokenizer can't be put into SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
