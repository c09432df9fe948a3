"""Op 8: benchmark decontamination by shared word runs and exact edit distance.

A document leaks an item when some run of its words is within ``percent`` % of the item's
words in (word) edit distance.

* A run within k edits of an item of L words shares at least L - q + 1 - k q of its q-word runs
  (q <= 3, chosen so that this is positive) and has at most L + k words.  So for each item only the
  stretches of a text count where so many of the item's own runs begin that close together.  A first
  count, over the runs of all items at once, leaves most texts out; neither count loses a leak.
* Every such stretch, with all words that a leak around it can have, is verified by the exact edit
  distance (bit-parallel, over the words).  All leaks are found, each with its fewest edits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common, words

PERCENT = 20
#: Items with fewer words are matched exactly, on their whole word run.
LEAST_WORDS = 8
#: Scripts without blanks (Thai to Myanmar, Khmer, Kana, Han, ..), each character of which is a word, their marks, and the first UTF-8 bytes of both.
ALONE = r"([\x{E00}-\x{109F}\x{1780}-\x{17FF}\x{1950}-\x{1AAF}\x{3005}-\x{3007}\x{3021}-\x{312F}\x{31A0}-\x{9FFF}\x{A980}-\x{A9FF}\x{AA60}-\x{AADF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{1AFF0}-\x{1B16F}\x{20000}-\x{3FFFF}])"
MARKS = r"[\x{E2F}\x{E5A}\x{E5B}\x{F0B}-\x{F0D}\x{104A}\x{104B}\x{17D4}-\x{17D6}\x{3000}-\x{3003}\x{3008}-\x{301F}\x{30FB}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}]"
LEADS = np.zeros(256, bool)
LEADS[[0xE0, 0xE1, *range(0xE3, 0xEB), 0xEF, 0xF0]] = True
#: Places of items' runs in a text that are laid out at once; more are taken by fewer items at a time.
PLACES_AT_ONCE = 1 << 20
#: Bytes of distinct item texts that one pass over the documents takes; more items take more passes.
ITEM_BYTES = 32 << 20


def most_edits(size: int, percent: int = PERCENT) -> int:
    return size * percent // 100 if size >= LEAST_WORDS else 0


def run_length(size: int, percent: int) -> int:
    """The longest run (of up to 3 words) of which a leak must share one with the item."""
    edits = most_edits(size, percent)
    return max(q for q in (1, 2, 3) if q == 1 or size - q + 1 - edits * q >= 1)


def least_runs(size: int, percent: int) -> int:
    """Runs that a leak shares with the item, at least."""
    q = run_length(size, percent)
    return max(1, size - q + 1 - most_edits(size, percent) * q)


def floor_size(size: int) -> int:
    """The least size of the class of sizes (each a quarter wider than the last) that share a first count."""
    least = 1
    while (following := least + max(1, least // 4)) <= size:
        least = following
    return least


def edit_search(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int] | None:
    """(edits, word after the end) of the best run of the text, by bit-parallel dynamic programming; None beyond ``most``."""
    size = len(item)
    where: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << size - 1
    plus, minus, edits, best = full, 0, size, None
    for j, w in enumerate(text.tolist()):
        equal = where.get(w, 0)
        zero = (((equal & plus) + plus) ^ plus) | equal | minus
        up, down = minus | ~(zero | plus) & full, plus & zero
        edits += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(zero | up) & full, up & zero
        if edits <= most and (best is None or edits < best[0]):
            best = (edits, j + 1)
    return best


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its words in order); characters of scripts without blanks are words of their own."""
    for lo in range(0, len(column), common.ROWS_AT_ONCE):
        part = column.slice(lo, common.ROWS_AT_ONCE).cast(pa.large_string())
        first, *_, last = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        if last > first and LEADS[np.frombuffer(part.buffers()[2], np.uint8)[first:last]].any():
            part = pc.replace_substring_regex(pc.replace_substring_regex(part, MARKS, " "), ALONE, r" \1 ")
        for i, text in words.documents(part, words.LETTERS):
            yield lo + i, text


@dataclass
class Items:
    """A block of items, ready to be searched for."""

    ids: list
    texts: list[np.ndarray]
    percent: int
    #: by run length: the runs of all items, sorted, and (run's place in them) * items + item, sorted
    runs: dict[int, np.ndarray] = field(default_factory=dict)
    owners: dict[int, np.ndarray] = field(default_factory=dict)
    #: by run length and class of sizes: runs that a leak shares at least, words that it has at most
    shapes: dict[tuple[int, int], list[int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        sizes = [len(t) for t in self.texts]
        self.most = np.array([most_edits(n, self.percent) for n in sizes], np.int64)
        self.least = np.array([least_runs(n, self.percent) for n in sizes], np.int64)
        self.longest = np.array(sizes, np.int64) + self.most
        of: dict[int, list[int]] = {}
        for i, n in enumerate(sizes):
            q = run_length(n, self.percent)
            of.setdefault(q, []).append(i)
            shape = self.shapes.setdefault((q, floor_size(n)), [n, 0])
            shape[0], shape[1] = min(shape[0], int(self.least[i])), max(shape[1], int(self.longest[i]))
        for q, mine in of.items():
            own = [words.runs(self.texts[i], q) for i in mine]
            self.runs[q], at = np.unique(np.concatenate(own), return_inverse=True)
            self.owners[q] = np.unique(at * len(sizes) + np.repeat(mine, [len(r) for r in own]))

    def near(self, q: int, hit: np.ndarray) -> np.ndarray:
        """Of the places where some item's run begins, those in a window with enough of them for a leak."""
        total = np.concatenate(([0], np.cumsum(hit)))
        inside = np.zeros(len(hit) + 1, np.int64)
        for (of, _), (least, longest) in self.shapes.items():
            if of == q and total[-1] >= least:
                end = np.minimum(np.arange(len(hit)) + longest - q + 1, len(hit))
                got = np.flatnonzero(total[end] - total[:-1] >= least)
                inside[got] += 1
                np.add.at(inside, end[got], -1)
        return np.flatnonzero(hit & (np.cumsum(inside)[:-1] > 0))

    def stretches(self, q: int, at: np.ndarray, run: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
        """(item, first word, word after the last) where items lo..hi - 1 can leak; ``run`` begins at word ``at``."""
        n, owners = len(self.texts), self.owners[q]
        first, last = (np.searchsorted(owners, run * n + edge) for edge in (lo, hi))
        count = last - first
        if (places := int(count.sum())) > PLACES_AT_ONCE and hi - lo > 1:
            yield from self.stretches(q, at, run, lo, (lo + hi) // 2)
            yield from self.stretches(q, at, run, (lo + hi) // 2, hi)
            return
        item = owners[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(places)] % n
        order = np.argsort(item, kind="stable")
        item, at = item[order], np.repeat(at, count)[order]
        # the place where enough of the item's runs have begun, counted from each
        enough = np.arange(places) + self.least[item] - 1
        inside = np.minimum(enough, places - 1)
        ok = (enough < places) & (item[inside] == item) & (at[inside] - at + q <= self.longest[item])
        item, begin, end = item[ok], at[inside][ok] + q - self.longest[item[ok]], at[ok] + self.longest[item[ok]]
        if len(item):
            # stretches of an item that overlap are one; both of their ends grow
            new = np.flatnonzero(np.concatenate(([True], (item[1:] != item[:-1]) | (begin[1:] > end[:-1]))))
            yield from zip(item[new].tolist(), np.maximum(begin[new], 0).tolist(), end[np.append(new[1:], len(item)) - 1].tolist())

    def search(self, text: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item's place, edits, first word searched, word after the end) of every leaked item, its best run."""
        best: dict[int, tuple[int, int, int]] = {}
        for q, known in self.runs.items():
            own = words.runs(text, q)
            run = np.minimum(np.searchsorted(known, own), len(known) - 1)
            at = self.near(q, known[run] == own)
            for i, first, last in self.stretches(q, at, run[at], 0, len(self.texts)) if len(at) else ():
                if i in best and not best[i][0]:
                    continue
                got = edit_search(self.texts[i], text[first:last], int(self.most[i]))
                if got and (i not in best or got[0] < best[i][0]):
                    best[i] = (got[0], first, first + got[1])
        return [(i, *b) for i, b in sorted(best.items())]


def leaks(spark: SparkSession, df: DataFrame, items: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, edits, end_word, n_words``: one row for each document (row) and item that it leaks.

    ``end_word`` is the word after the best run's end, ``n_words`` the item's words.  Null and empty texts
    leak nothing; items that are null or have no words are left out, those with fewer than
    ``LEAST_WORDS`` words leak only where all of them stand in a row.  Repeated rows
    give repeated results; empty tables an empty one; other columns are ignored.
    """
    wanted = _keyed(items, item_id, item_text)
    found = _found(spark, common.pick(df, doc_id=doc_id, text=text), wanted, percent)
    return found.join(wanted.select("item_id", "key"), "key").select("doc_id", "item_id", "edits", "end_word", "n_words")


def _keyed(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """The items with a text, and ``key``, which equal texts share."""
    return common.pick(items, item_id=item_id, text=item_text).where("text is not null").withColumn("key", F.sha2("text", 256))


def _found(spark: SparkSession, rows: DataFrame, wanted: DataFrame, percent: int) -> DataFrame:
    """``doc_id, key, edits, end_word, n_words`` of each document and item text that it leaks."""
    wanted = wanted.select("key", "text").dropDuplicates(["key"])
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // ITEM_BYTES) or 1
    out = None
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block)
        found = _block(spark, rows, part, percent)
        out = found if out is None else out.unionByName(found)
    return out


def _block(spark: SparkSession, rows: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    got = items.orderBy("key").toArrow()
    texts = dict(word_hashes(got.column("text").combine_chunks())) if got.num_rows else {}
    use = [i for i in range(got.num_rows) if len(texts[i])]
    ids = got.column("key").to_pylist()
    shared = spark.sparkContext.broadcast(([ids[i] for i in use], [texts[i] for i in use]))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, key string, edits int, end_word bigint, n_words int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Items(*shared.value, percent)
        for batch in batches:
            at, out = [], []
            for i, text in word_hashes(batch.column("text")):
                for item, edits, _, end in block.search(text):
                    at.append(i)
                    out.append((block.ids[item], edits, end, len(block.texts[item])))
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), *columns], ["doc_id", "key", "edits", "end_word", "n_words"])

    return rows.mapInArrow(run, schema)


def drop_leaks(spark: SparkSession, df: DataFrame, items: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that leak no item, with all their columns."""
    rows, restore = common.tracked(spark, df, doc_id, text)
    found = _found(spark, rows.select(F.col("rid").alias("doc_id"), "text"), _keyed(items, "item_id", "text"), percent)
    found = common.stage(spark, found.select(F.col("doc_id").alias("rid")).distinct(), "leaks")
    return restore(rows.join(found, "rid", "left_anti"))
