"""Op 10: language identification by the nearest of several centroids per language.

A text is the normalised TF-IDF vector of its hashed byte trigrams.  The inverse document
frequencies come from all documents that may be learned from; the centroids (spherical
k-means, ``CENTROIDS`` per language) from a bounded sample of them.  A text gets the language
of the centroid with the largest cosine.  It is rejected when that cosine is below ``REJECT``
times the centroid's usual one (less for texts with few trigrams, whose cosine is small by
itself), i.e. when it is far from every language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import common, ngrams

BITS = 12
#: Labelled documents per language that the centroids are fitted on (expected number; chosen by a hash of the id).
SAMPLE = 400
CENTROIDS = 4
ROUNDS = 12
#: Rejected below this share of the centroid's mean cosine with its own sample.
REJECT = 0.25
#: Distinct trigrams from which on a text's cosine no longer depends on its length.
FULL = 200


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    usual: np.ndarray

    def vectors(self, texts: list[str]) -> np.ndarray:
        return vectors(texts, self.idf)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    for i, text in enumerate(texts):
        if text:
            out[i] = np.log1p(ngrams.counts(text, BITS, True)) * idf
    length = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.maximum(length, 1e-9)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each trigram, and all documents, over every learnable row."""
    size = (1 << BITS) + common.CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for part in common.slices(batch):
                for text in common.texts(part):
                    df[: 1 << BITS] += ngrams.counts(text, BITS, True) > 0
                    df[1 << BITS] += 1
        got = list(common.table_rows(df))
        yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.binary())], ["part", "body"])

    total = common.add_tables(rows.select("text").mapInArrow(run, common.SUM_SCHEMA), size, "int64")
    return total[: 1 << BITS], int(total[1 << BITS])


def _k_means(points: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from a fixed start (each next centre is the point farthest from the others)."""
    centres = [points.mean(0)]
    near = points @ centres[0]
    for _ in range(min(k, len(points)) - 1):
        centres.append(points[int(near.argmin())])
        near = np.maximum(near, points @ centres[-1])
    found = np.stack(centres)
    for _ in range(ROUNDS):
        found /= np.maximum(np.sqrt((found * found).sum(1, keepdims=True)), 1e-9)
        best = (points @ found.T).argmax(1)
        found = np.stack([points[best == j].mean(0) if (best == j).any() else found[j] for j in range(len(found))])
    return found / np.maximum(np.sqrt((found * found).sum(1, keepdims=True)), 1e-9)


def fit(rows: DataFrame) -> Model:
    """rows: doc_id, text, lang.  Held-out rows, null languages and texts without words teach nothing."""
    learn = rows.where(~common.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    df, n = _frequencies(learn)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1
    sizes = learn.groupBy("lang").agg((SAMPLE / F.count("*")).alias("share"))
    some = common.drawn(learn.join(F.broadcast(sizes), "lang"), ["lang", "doc_id", "text"], F.col("share"))
    some = some.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw"))).where(F.col("place") <= SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                got = vectors(common.texts(part), idf)
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([v.astype(np.float16).tobytes() for v in got], pa.binary())], ["lang", "vector"])

    def centres(keys, frame):
        points = np.stack([np.frombuffer(b, np.float16) for b in sorted(map(bytes, frame["vector"]))]).astype(np.float32)
        points = points[(points != 0).any(1)]
        if not len(points):
            return pd.DataFrame({"lang": [], "centre": [], "usual": []})
        found = _k_means(points, CENTROIDS)
        cosine = points @ found.T
        best = cosine.argmax(1)
        usual = [float(cosine[best == j, j].mean() if (best == j).any() else cosine.max(1).mean()) for j in range(len(found))]
        return pd.DataFrame({"lang": [keys[0]] * len(found), "centre": [c.tobytes() for c in found], "usual": usual})

    sample = some.select("lang", "text").mapInArrow(run, "lang string, vector binary")
    got = sample.groupBy("lang").applyInPandas(centres, "lang string, centre binary, usual double").collect()
    got = sorted(got, key=lambda r: (r["lang"], bytes(r["centre"])))
    centroids = [np.zeros((0, 1 << BITS), np.float32), *[np.frombuffer(r["centre"], np.float32)[None] for r in got]]
    return Model(idf, np.concatenate(centroids), [r["lang"] for r in got], np.array([r["usual"] for r in got]))


def identify(spark: SparkSession, rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """The key columns of every row with lang_pred, score and rejected."""
    shared = spark.sparkContext.broadcast(model)
    fields = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in common.slices(batch, 128):
                texts = common.texts(part)
                known = np.array([has_letter(t) for t in texts], bool) & bool(model.languages)
                found = model.vectors(texts)
                least = REJECT * np.minimum(1, np.sqrt((found != 0).sum(1) / FULL))
                cosine = found @ model.centroids.T if model.languages else np.zeros((len(texts), 1))
                best = cosine.argmax(1)
                score = np.where(known, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0).astype(float)
                lang = [model.languages[b] if k else "und" for b, k in zip(best, known)]
                usual = model.usual[best] if model.languages else 0
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in keys], pa.array(lang, pa.string()), pa.array(score), pa.array(~known | (score < least * usual))],
                    [*keys, "lang_pred", "score", "rejected"],
                )

    out = rows.select(*keys, "text").mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")
    return out


def language_id(spark: SparkSession, df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score, rejected``.

    ``lang_pred`` is a language of the learned rows; ``und`` (score 0, rejected) for a null text, one
    without letters, or when nothing could be learned.  ``score`` is the cosine with the nearest
    centroid.  Repeated rows get equal results, an empty table an empty one; other columns are ignored.
    """
    rows = common.pick(df, doc_id=doc_id, text=text, lang=lang)
    model = fit(rows)
    out = identify(spark, rows, model, ["doc_id"])
    return out.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(spark: SparkSession, df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that are not rejected, with all their columns; the model is fitted on the rows themselves."""
    model = fit(common.pick(df, doc_id=doc_id, text=text, lang=lang))
    names = df.columns
    columns = common.numbered(df)
    rows = columns.withColumn("text", F.col(f"c{names.index(text)}"))
    keys = columns.columns
    kept = identify(spark, rows, model, keys).where("not rejected")
    return kept.select(*keys).toDF(*names)
