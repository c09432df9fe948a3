"""Op 9: quality by cumulative-link (proportional odds) regression on graded ratings.

A rating is an ordered grade 0..G.  One weight vector over hashed byte trigrams is shared by
all grades; ordered thresholds cut its score: P(grade >= g) = sigmoid(score - threshold_g).
That gives an expected grade and tail probabilities, by which documents are selected.

It is fitted on a bounded sample of the labelled rows (``SAMPLE``) and scores all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paddock.operators.joins import dimension

from . import common, ngrams

BITS = 13
#: Labelled rows that the model is fitted on (expected number; chosen by a hash of the id).
SAMPLE = 6000
STEPS = 200
RATE = 0.05
RIDGE = 1e-4
#: A document is selected when P(grade >= 1) reaches this.
SELECT = 0.5
#: A labels table with at most so many rows may be broadcast.
BROADCAST_ROWS = 2_000_000


def grade() -> Column:
    """The grade that ``labels`` imply: 0 poor, 1 good but toxic, 2 good and clean."""
    return F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, values): damped trigram counts, scaled to length 1."""
    found = ngrams.counts(text, BITS, False)
    at = np.flatnonzero(found)
    value = np.log1p(found[at])
    return at, (value / np.sqrt((value * value).sum() or 1)).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, text: str) -> np.ndarray:
        """P(grade >= g) for g = 1..G."""
        at, value = features(text)
        return _sigmoid(float(self.weights[at] @ value) - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(at: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, top: int) -> Model:
    """Maximum likelihood with a ridge, by Adam over the whole sample; thresholds stay ordered."""
    if not len(grades):
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(top))
    row = np.repeat(np.arange(len(at)), [len(a) for a in at])
    col, val = np.concatenate(at), np.concatenate(values).astype(np.float64)
    shares = [(np.mean(grades >= g) * len(grades) + 0.5) / (len(grades) + 1) for g in range(1, top + 1)]
    cuts = -np.log(np.array(shares) / (1 - np.array(shares)))
    # the first threshold, and logs of the gaps between the next ones
    free = np.concatenate((cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))))
    w = np.zeros(1 << BITS)
    m, v = [np.zeros_like(w), np.zeros_like(free)], [np.zeros_like(w), np.zeros_like(free)]
    for step in range(1, STEPS + 1):
        cuts = free[0] + np.concatenate(([0], np.cumsum(np.exp(free[1:]))))
        score = np.bincount(row, w[col] * val, len(at))
        tail = np.concatenate((np.ones((len(at), 1)), _sigmoid(score[:, None] - cuts), np.zeros((len(at), 1))), 1)
        slope = tail * (1 - tail)
        k = np.arange(len(at))
        p = np.maximum(tail[k, grades] - tail[k, grades + 1], 1e-9)
        d_score = -(slope[k, grades] - slope[k, grades + 1]) / p / len(at)
        d_cut = np.array([((np.where(grades == g, slope[:, g], 0) - np.where(grades + 1 == g, slope[:, g], 0)) / p).sum() for g in range(1, top + 1)]) / len(at)
        d_free = np.concatenate(([d_cut.sum()], [d_cut[g:].sum() * np.exp(free[g]) for g in range(1, top)]))
        grads = [np.bincount(col, d_score[row] * val, len(w)) + RIDGE * w, d_free]
        for j, x in enumerate((w, free)):
            m[j] = 0.9 * m[j] + 0.1 * grads[j]
            v[j] = 0.99 * v[j] + 0.01 * grads[j] ** 2
            x -= RATE * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.99**step)) + 1e-8)
    cuts = free[0] + np.concatenate(([0], np.cumsum(np.exp(free[1:]))))
    return Model(w.astype(np.float32), cuts)


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with their labels; of labels that share an id the largest counts.  They are broadcast only when
    their number and bytes are measured as small, else both sides are shuffled."""
    return rows.join(dimension(one_each(labels), BROADCAST_ROWS), "doc_id")


def one_each(labels: DataFrame) -> DataFrame:
    """One row per id, with the largest value of every other column: the same however the rows are dealt."""
    return labels.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in labels.columns if c != "doc_id"])


def fit(rows: DataFrame, graded: DataFrame, top: int = 2) -> Model:
    """rows: doc_id, text; graded: doc_id, grade (null grades teach nothing)."""
    graded = one_each(graded.where(F.col("grade").isNotNull() & ~common.held_out(F.col("doc_id"))))
    share = F.lit(min(1.0, SAMPLE / max(1, graded.count())))
    chosen = common.drawn(graded, ["doc_id"], share).orderBy("draw").limit(SAMPLE).select("doc_id", "grade")
    # of rows that share an id, one teaches
    sample = labelled(rows, chosen).groupBy("doc_id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                got = [features(t) for t in common.texts(part)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.string()), part.column("grade").cast(pa.int32()),
                        pa.array([a.astype(np.uint16).tobytes() for a, _ in got], pa.binary()), pa.array([v.tobytes() for _, v in got], pa.binary()),
                    ],
                    ["doc_id", "grade", "places", "vals"],
                )

    got = sorted(sample.mapInArrow(run, "doc_id string, grade int, places binary, vals binary").collect(), key=lambda r: r["doc_id"])
    return train(
        [np.frombuffer(r["places"], np.uint16).astype(np.int64) for r in got], [np.frombuffer(r["vals"], np.float32) for r in got],
        np.clip(np.array([r["grade"] for r in got], np.int64), 0, top), top,
    )


def quality(spark: SparkSession, df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, expected_grade, p_good, p_best, selected``.

    ``labels``: doc_id, quality, toxic.  p_good = P(grade >= 1), p_best = P(grade >= 2).  A null text counts
    as empty.  Without labels every document gets the same grade.  Repeated rows get equal results, an
    empty table an empty one; other columns are ignored; of labels that share an id the best grade counts.
    """
    rows = common.pick(df, doc_id=doc_id, text=text)
    graded = common.pick(labels, doc_id="doc_id", quality="quality", toxic="toxic")
    graded = graded.where("quality is not null").select("doc_id", grade().alias("grade"))
    shared = spark.sparkContext.broadcast(fit(rows, graded))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in common.slices(batch):
                tails = np.array([model.tails(t) for t in common.texts(part)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(tails.sum(1)), pa.array(tails[:, 0]), pa.array(tails[:, -1]), pa.array(tails[:, 0] >= SELECT)],
                    ["doc_id", "expected_grade", "p_good", "p_best", "selected"],
                )

    out = rows.mapInArrow(run, f"doc_id {kind}, expected_grade double, p_good double, p_best double, selected boolean")
    return out.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "p_good", "p_best", "selected")
