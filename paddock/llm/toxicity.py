"""Op 2: toxic passages by maximum-scoring segments.

* A word's tokens are the word and its first ``STEM`` bytes.  A token has log-odds between toxic
  and clean text, with an informative Dirichlet prior (its share of all labelled text), shrunk by
  their standard error.  A word scores the larger one, minus a drift that makes the expected
  score of clean text negative.  Counts are taken over all labelled documents that may be
  learned from, in tables of fixed size (hashed tokens).
* A linear-time scan (all maximal scoring segments, found by joining runs of positive scores)
  gives every passage of a document.
* Extreme-value theory calibrates them: in clean text of n words, a segment of score S is
  expected K n exp(-lambda S) times.  lambda solves E[exp(lambda score)] = 1 under the clean
  words.  Passages expected fewer than ``SIGNIFICANT`` times are reported; the evidence of a document is
  the sum of -log(expected) over them.  A monotone link, fitted on the evidence of all labelled documents,
  turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common, words
from .quality import labelled

BITS = 18
#: Bytes of a word's stem.
STEM = 6
#: Weight of the prior, in words.
PRIOR = 5000.0
#: Standard errors that a word's log-odds are shrunk by.
SHRINK = 2.0
#: Taken off every word's score.
DRIFT = 0.2
#: The least log-odds that count.
FLOOR = np.float32(-2.0)
#: A passage is significant when clean text of the document's length is expected to have fewer such.
SIGNIFICANT = 0.05
PREDICT = 0.7
#: Places of the table of evidences (steps of 1/8 up to 256, the last open).
STEPS = 2048


#: Places of the words, and of their stems, in the tables.
Tokens = tuple[np.ndarray, np.ndarray]


def evidence(segments: list[tuple[int, int, float, float]]) -> float:
    return float(sum(-np.log(max(expected, 1e-300)) for *_, expected in segments))


def tokens_of(column: pa.Array) -> Iterator[tuple[int, Tokens]]:
    """(row, tokens) of every row of a text column."""
    place = lambda hashes: (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    both = zip(words.documents(column, words.LETTERS), words.documents(column, words.LETTERS, STEM))
    for (i, whole), (_, stems) in both:
        yield i, (place(whole), place(stems))


@dataclass
class Model:
    scores: np.ndarray
    rate: float
    scale: float
    link: tuple[float, float]

    def of(self, tokens: Tokens) -> np.ndarray:
        """The words' scores."""
        return np.maximum(np.maximum(self.scores[0][tokens[0]], self.scores[1][tokens[1]]), FLOOR) - np.float32(DRIFT)

    def segments(self, tokens: Tokens) -> list[tuple[int, int, float, float]]:
        """(first word, word after the last, score, expected number) of the significant passages in order."""
        score = self.of(tokens)
        room = np.log(max(len(score), 1) * self.scale)
        out = []
        for start, end, total in maximal_segments(score):
            log_expected = room - self.rate * total
            if log_expected < np.log(SIGNIFICANT):
                out.append((start, end, total, float(np.exp(log_expected))))
        return out

    def evidence(self, tokens: Tokens) -> float:
        return evidence(self.segments(tokens))

    def score(self, evidence: float) -> float:
        a, b = self.link
        return float(1 / (1 + np.exp(-np.clip(a + b * np.log1p(evidence), -40, 40))))


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, total) in order, in linear time.

    A segment is kept when no part of it scores more and no extension does.  Runs of positive
    scores are taken from left to right; a run joins the nearest earlier segment that starts lower,
    unless that one also ends at least as high.
    """
    positive = score > 0
    if not positive.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate(([False], positive, [False])).view(np.int8)))
    total = np.concatenate(([0.0], np.cumsum(score, dtype=np.float64)))
    stack: list[list] = []  # [start, end, sum before, sum after, index of the nearest earlier one that starts lower]
    for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
        low, high = float(total[start]), float(total[end])
        back = len(stack) - 1
        while True:
            while back >= 0 and stack[back][2] >= low:
                back = stack[back][4]
            if back < 0 or stack[back][3] >= high:
                stack.append([start, end, low, high, back])
                break
            start, low = stack[back][0], stack[back][2]
            del stack[back:]
            back = len(stack) - 1
    return [(s, e, high - low) for s, e, low, high, _ in stack]


def token_scores(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Shrunk log-odds of each hashed token."""
    both = toxic + clean + 0.0
    prior = PRIOR * (both + 0.01) / (both + 0.01).sum()
    odds, error = 0.0, 0.0
    for counts, sign in ((toxic, 1), (clean, -1)):
        own = counts + prior
        odds = odds + sign * (np.log(own) - np.log(own.sum() - own))
        error = error + 1 / own
    error = np.sqrt(error)
    return (np.sign(odds) * np.maximum(np.abs(odds) - SHRINK * error, 0)).astype(np.float32)


def extreme_value(score: np.ndarray, count: np.ndarray) -> tuple[float, float]:
    """(lambda, K) of clean text, whose words have these scores so often: lambda by bisection; K is the share of positive scores."""
    p = count / max(count.sum(), 1)
    if not count.any() or not (p[score > 0] > 0).any() or (p * score).sum() >= 0:
        return 1.0, 1.0
    mean = lambda rate: (p * np.exp(np.minimum(rate * score, 500))).sum()
    lo, hi = 0.0, 1.0
    while mean(hi) < 1 and hi < 1e3:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    return hi, float(max(p[score > 0].sum(), 1e-6))


def _tables(rows: DataFrame, size: int, add) -> np.ndarray:
    """Sum of fixed-size tables that add(table, a text's tokens, its label) fills in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in common.slices(batch):
                toxic = part.column("toxic").to_pylist()
                for i, tokens in tokens_of(part.column("text")):
                    add(total, tokens, toxic[i])
        got = list(common.table_rows(total))
        yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.binary())], ["part", "body"])

    return common.add_tables(rows.select("text", "toxic").mapInArrow(run, common.SUM_SCHEMA), size, "int64")


def _link(table: np.ndarray) -> tuple[float, float]:
    """(a, b) of P(toxic) = sigmoid(a + b log(1 + evidence)), by Newton's method over the table of all labelled documents."""
    table = table.reshape(2, STEPS).astype(float)
    x = np.log1p(np.arange(STEPS) / 8)
    n, y = table.sum(0), table[1]
    if not y.sum() or not (n - y).sum():
        return (-4.0, 4.0)
    w = np.zeros(2)
    design = np.stack([np.ones(STEPS), x], 1)
    ridge = np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - n * p) - ridge @ w
        step = np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + ridge, gradient)
        w = w + np.clip(step, -2, 2)
    return float(w[0]), float(max(w[1], 0.0))


def fit(spark: SparkSession, rows: DataFrame, labels: DataFrame) -> Model:
    """rows: doc_id, text; labels: doc_id, toxic.  Held-out rows teach nothing."""
    teach = labels.where(F.col("toxic").isNotNull() & ~common.held_out(F.col("doc_id")))
    learn = labelled(rows, teach).where(F.col("text").isNotNull())

    def count(total, tokens, toxic):
        for k, at in enumerate(tokens):
            np.add.at(total.reshape(2, 2, -1)[k, int(toxic == 1)], at, 1)

    counts = _tables(learn, 4 << BITS, count).reshape(2, 2, -1)
    model = Model(np.stack([token_scores(toxic, clean) for clean, toxic in counts]), 1.0, 1.0, (0.0, 1.0))
    first = spark.sparkContext.broadcast(model)
    low, step = float(FLOOR) - DRIFT, 1 / 64  # the scores in steps

    def spread(total, tokens, toxic):
        at = np.maximum((first.value.of(tokens) - low) / step, 0).astype(np.int64)
        total += np.bincount(np.minimum(at, STEPS - 1), minlength=STEPS)

    clean = learn.where("toxic = 0")
    model.rate, model.scale = extreme_value(low + np.arange(STEPS) * step, _tables(clean, STEPS, spread))
    second = spark.sparkContext.broadcast(model)

    def see(total, tokens, toxic):
        at = min(STEPS - 1, int(second.value.evidence(tokens) * 8))
        total[(STEPS if toxic == 1 else 0) + at] += 1

    model.link = _link(_tables(learn, 2 * STEPS, see))
    return model


def _texts_scored(spark: SparkSession, df: DataFrame, labels: DataFrame, doc_id: str, text: str, passages: bool) -> DataFrame:
    rows = common.pick(df, doc_id=doc_id, text=text)
    model = fit(spark, rows, common.pick(labels, doc_id="doc_id", toxic="toxic"))
    shared = spark.sparkContext.broadcast(model)
    kind = rows.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in common.slices(batch):
                found: list[list] = [[] for _ in range(part.num_rows)]
                for i, tokens in tokens_of(part.column("text")):
                    found[i] = model.segments(tokens)
                score = np.array([model.score(evidence(f)) for f in found], float)
                last = pa.array([[dict(zip(("start", "end", "score", "expected"), x)) for x in f] for f in found], pa.list_(span))
                out = [part.column("doc_id"), pa.array(score), pa.array((score >= PREDICT).astype(np.int32)), pa.array([len(f) for f in found], pa.int64())]
                names = ["doc_id", "score", "predicted", "n_passages"]
                yield pa.RecordBatch.from_arrays([*out, last][: 5 if passages else 4], [*names, "passages"][: 5 if passages else 4])

    schema = f"doc_id {kind}, score double, predicted int, n_passages bigint"
    if passages:
        schema += ", passages array<struct<start: bigint, end: bigint, score: double, expected: double>>"
    return rows.mapInArrow(run, schema)


def toxicity(spark: SparkSession, df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted, n_passages``.

    A null or empty text has no passage and the lowest score.  Without labels nothing is significant by
    more than chance.  Repeated rows get equal results, an empty table an empty one; of labels
    that share an id the largest counts; other columns are ignored.
    """
    out = _texts_scored(spark, df, labels, doc_id, text, False)
    return out.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_passages")


def toxic_passages(spark: SparkSession, df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted, n_passages, passages``: word positions, score and expected number of each passage."""
    return _texts_scored(spark, df, labels, doc_id, text, True)
