"""Op 11: fill-in-middle transformation by a piecewise-linear learned rank index.

A text is cut at code points, but it is held as UTF-8 bytes.  The index maps the rank of every code
point boundary of a batch to its byte offset: straight segments fitted with an error bound, and the
exact remainder of each boundary in one signed byte.  A cut is predicted by its segment and corrected
by its remainder; no text is decoded or walked for it.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes by which a segment may miss a boundary: with one for rounding, a remainder fits a signed byte.
ERROR = 120
#: Bytes whose boundaries are looked at together while the index is built.
BLOCK = 1 << 20
#: Bend points that are tried at first when a segment is grown.
STRETCH = 64

SCHEMA = "doc_id {id}, n long, form string, prefix_chars long, middle_chars long, output string"


def fit(offsets: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray]:
    """(ranks at which segments begin, slopes): every offset lies within ``error`` of its segment's line.

    A segment grows as long as one line through its first boundary meets all others within the
    error: the cone of slopes that do narrows with each boundary.  Boundaries between two bends
    lie on a line, so that the bends alone narrow it.
    """
    last = len(offsets) - 1
    bends = np.append(np.flatnonzero(np.diff(offsets, n=2)) + 1, last)
    starts, slopes, at, first = [0], [], 0, 0
    while True:
        low, high, k, size = -np.inf, np.inf, first, STRETCH
        while k < len(bends):
            run = bends[k : k + size]
            dx, dy = run - at, offsets[run] - offsets[at]
            dx = np.maximum(dx, 1)
            lows = np.maximum(np.maximum.accumulate((dy - error) / dx), low)
            highs = np.minimum(np.minimum.accumulate((dy + error) / dx), high)
            wide = lows <= highs
            fits = len(run) if wide.all() else int(np.argmin(wide))
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            k += fits
            if fits < len(run):
                break
            size *= 2
        slopes.append((low + high) / 2)
        if k >= len(bends):
            return np.array(starts), np.array(slopes)
        at, first = int(bends[k - 1]), k
        starts.append(at)


class RankIndex:
    """Byte offset of every code point boundary in UTF-8 bytes, the end included."""

    def __init__(self, data: np.ndarray, block: int = BLOCK, error: int = ERROR):
        starts, bases, slopes, rest, rank = [], [], [], [], 0
        for lo in range(0, len(data) + 1, block):
            offsets = np.flatnonzero((data[lo : lo + block] & 0xC0) != 0x80) + lo
            if lo + block > len(data):
                offsets = np.append(offsets, len(data))
            if not len(offsets):
                continue
            at, slope = fit(offsets, error)
            segment = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(offsets))))
            line = offsets[at][segment] + np.floor(slope[segment] * (np.arange(len(offsets)) - at[segment])).astype(np.int64)
            rest.append((offsets - line).astype(np.int8))
            starts.append(at + rank)
            bases.append(offsets[at])
            slopes.append(slope)
            rank += len(offsets)
        self.starts, self.bases, self.slopes = map(np.concatenate, (starts, bases, slopes))
        self.rest = np.concatenate(rest)

    def __getitem__(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.starts, ranks, "right") - 1
        line = self.bases[segment] + np.floor(self.slopes[segment] * (ranks - self.starts[segment])).astype(np.int64)
        return line + self.rest[ranks]


def draws(ids: list[str]) -> np.ndarray:
    """Four unsigned numbers for each id: the first 32 digits of the hash of ``1:`` and the id."""
    return np.array([struct.unpack(">4I", hashlib.sha256(b"1:" + i.encode()).digest()[:16]) for i in ids], np.int64).reshape(-1, 4)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offset at which each begins and the last one ends)."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def forms(texts: pa.Array, ids: list[str]) -> dict[str, list]:
    """Columns n, form, prefix_chars, middle_chars and output of these texts."""
    data, at = utf8(texts)
    n = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    h = draws(ids)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    ranks = np.concatenate(([0], np.cumsum(n)))[:-1, None] + cuts
    ends = RankIndex(data)[ranks.ravel()].reshape(-1, 2)
    whole, marks = data.tobytes(), [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    out: dict[str, list] = {k: [] for k in ("form", "prefix_chars", "middle_chars", "output")}
    for i in range(len(ids)):
        body = whole[at[i] : at[i + 1]]
        one, two = ends[i] - at[i]
        if not body or h[i, 2] % 100 >= 90 or any(mark in body for mark in marks):
            row = ("plain", None, None, body)
        elif h[i, 3] % 100 < 20:
            row = ("spm", int(cuts[i, 0]), int(cuts[i, 1] - cuts[i, 0]), b"".join((s, body[two:], p, body[:one], m, body[one:two])))
        else:
            row = ("psm", int(cuts[i, 0]), int(cuts[i, 1] - cuts[i, 0]), b"".join((p, body[:one], s, body[two:], m, body[one:two])))
        for column, value in zip(out.values(), row):
            column.append(value)
    return {"n": n, **out}


def fill_in_middle(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    The cuts and the form follow from the id alone, so that equal ids are cut at equal draws and repeated
    rows give repeated results.  A null id draws like an empty one.  A null text counts as empty, and
    an empty text is plain.  No other column is read; an empty table gives an empty result.
    """
    rows = common.pick(df, doc_id=doc_id, text=text)
    rows = rows.withColumn("draw", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                got = forms(pc.fill_null(part.column("text"), ""), part.column("draw").to_pylist())
                output = pa.array(got["output"], pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(got["n"], pa.int64()), pa.array(got["form"], pa.string()),
                     pa.array(got["prefix_chars"], pa.int64()), pa.array(got["middle_chars"], pa.int64()), output],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return rows.mapInArrow(transform, SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString()))


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made from, taken from form and output alone."""
    size = len(PREFIX)

    def between(first: str | None, second: str | None) -> Column:
        lo = F.instr(output, F.lit(first)) + size
        hi = F.instr(output, F.lit(second)) if second else F.char_length(output) + 1
        return F.substring(output, lo, hi - lo)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``fill_in_middle`` with the hashes of output and restored text in place of the output."""
    made = fill_in_middle(df, doc_id, text)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")).cast("binary"), 256).alias("restored_sha256"),
    )
