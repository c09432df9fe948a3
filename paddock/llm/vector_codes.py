"""Op 13: vector codes by product quantisation, its codebooks fitted by dual-tree Lloyd rounds.

A vector of integers is cut into equal consecutive parts; the code of a part is the number of the
nearest entry in its position's codebook.  Vectors are kept in blocks.  For each position a block
holds a tree over its parts: nodes of halved size, each with its box and the sum of its parts.  A
second tree is made over the entries of the codebook.  Both are descended together, as pairs of a part node
and an entry node: a pair goes when its least possible distance is beyond what another entry surely
offers to every part of the node.  A part node that one entry is left for is assigned whole, by its stored sum;
leaves with several entries left are settled by the integer distances of their parts.

The trees over parts are built once and staged.  A round is one pass over them, whose sums of each
entry are added up on executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .topk_search import whole_vectors

#: Vectors of a block, and parts of a leaf (at most twice that many).
BLOCK_ROWS, LEAF = 4096, 8
#: Rows whose labels are so frequent that no more than this number of labels can be.
HOT_LABELS = 1000

BLOCK_SCHEMA = "ids array<{id}>, labels array<{label}>, n int, parts binary, places binary, low binary, high binary, sums binary"


class Tree:
    """Halving trees over n points of each of several positions, given as an array (position, point, component).

    The nodes of all levels lie one after another, level by level; ``cut(level)`` gives the places at which the nodes of a
    level begin, in the order that ``order`` puts the points into.
    """

    def __init__(self, n: int, leaf: int):
        self.n, self.depth = n, max(0, (max(n, 1) // leaf).bit_length() - 1)

    def cut(self, level: int) -> np.ndarray:
        return np.arange((1 << level) + 1, dtype=np.int64) * self.n >> level

    def order(self, points: np.ndarray) -> np.ndarray:
        """For each position the points in the order of the leaves; a node is halved along its widest component."""
        places = np.tile(np.arange(self.n), (len(points), 1))
        for level in range(self.depth):
            cut = self.cut(level)
            now = np.take_along_axis(points, places[:, :, None], axis=1)
            wide = (np.maximum.reduceat(now, cut[:-1], axis=1) - np.minimum.reduceat(now, cut[:-1], axis=1)).argmax(axis=2)
            node = np.repeat(np.arange(1 << level), np.diff(cut))
            value = np.take_along_axis(now, wide[:, node][:, :, None], axis=2)[:, :, 0]
            # a node's points stay in its place: sort by node, then by the chosen component
            places = np.take_along_axis(places, np.lexsort((value, np.broadcast_to(node, value.shape))), axis=1)
        return places

    def levels(self, sorted_points: np.ndarray, function) -> np.ndarray:
        """``function.reduceat`` of every node's points, all levels in one array (position, node, component)."""
        made = [function.reduceat(sorted_points, self.cut(self.depth)[:-1], axis=1)]
        for _ in range(self.depth):  # a node from its two halves
            made.append(function(made[-1][:, ::2], made[-1][:, 1::2]))
        return np.concatenate(made[::-1], axis=1)


def boxes(tree: Tree, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tree.levels(points, np.minimum), tree.levels(points, np.maximum)


class EntryTree:
    """The tree over the entries of every position; its leaves are single entries.

    Halving down to one needs a power of two: the last entry is repeated up to it, under its own index.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count = entries.shape[1]
        index = np.minimum(np.arange(1 << (count - 1).bit_length()), count - 1)
        self.tree = Tree(len(index), 1)
        order = self.tree.order(entries[:, index])
        self.places = index[order]
        self.low, self.high = boxes(self.tree, np.take_along_axis(entries, self.places[:, :, None], axis=1))


def bounds(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) squared distance between any points of two boxes."""
    apart = np.maximum(np.maximum(other_low - high, low - other_high), 0)
    across = np.maximum(other_high - low, high - other_low)
    return (apart * apart).sum(axis=1), (across * across).sum(axis=1)


def runs(group: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)


def spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, number within it) of sizes[0] things of group 0, sizes[1] of group 1, .."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def assign(tree: Tree, points: np.ndarray, low: np.ndarray, high: np.ndarray, book: EntryTree) -> tuple[list, list]:
    """(whole, single): the nearest entries of all parts, ties to the lower index.

    ``whole`` has arrays (position, level, node, entry) of nodes that are assigned whole, ``single``
    arrays (position, place, entry) of parts that are assigned one by one.
    """
    positions, entries = len(points), book.entries.shape[1]
    whole, single = [], []
    # pairs of a part node and an entry node, ordered by position and part node
    pos, node = np.arange(positions), np.zeros(positions, np.int64)
    other = np.zeros(positions, np.int64)
    level = book_level = 0
    while len(pos):
        a, b = (1 << level) - 1 + node, (1 << book_level) - 1 + other
        least, most = bounds(low[pos, a], high[pos, a], book.low[pos, b], book.high[pos, b])
        begins = runs(pos * (1 << level) + node)
        group, _ = spread(np.diff(np.append(begins, len(pos))))
        offer = np.minimum.reduceat(most, begins)[group]
        near = least <= offer
        leaves = book_level == book.tree.depth
        if leaves:
            # of entries that can but tie, the lowest index wins
            entry = book.places[pos, other]
            sure = np.minimum.reduceat(np.where(most == offer, entry, entries), begins)[group]
            near &= (least < offer) | (entry <= sure)
        pos, node, other, group = pos[near], node[near], other[near], group[near]
        if leaves:
            entry = entry[near]
            alone = np.bincount(group, minlength=len(begins))[group] == 1
            whole.append((pos[alone], np.full(alone.sum(), level), node[alone], entry[alone]))
            pos, node, other, entry = pos[~alone], node[~alone], other[~alone], entry[~alone]
            if level == tree.depth:
                single.append(settle(tree, points, pos, node, entry, book.entries))
                break
        halves = 2 if level < tree.depth else 1
        parts = 1 if leaves else 2
        # the pairs of a part node become those of its halves, one half's after the other's
        begins = runs(pos * (1 << level) + node)
        pairs = np.diff(np.append(begins, len(pos)))
        group, i = spread(pairs * halves * parts)
        half, i = np.divmod(i, pairs[group] * parts)
        at = begins[group] + i // parts
        pos, node, other = pos[at], node[at] * halves + half, other[at] * parts + i % parts
        level += halves - 1
        book_level += parts - 1
    return whole, single


def settle(tree: Tree, points: np.ndarray, pos: np.ndarray, node: np.ndarray, entry: np.ndarray, entries: np.ndarray) -> tuple:
    """(position, place, entry) of every part in these leaves, by its integer distances to the entries left for its leaf."""
    cut, count = tree.cut(tree.depth), entries.shape[1]
    begins = runs(pos * (1 << tree.depth) + node)
    pairs = np.diff(np.append(begins, len(pos)))
    leaf = node[begins]
    group, i = spread(pairs * (cut[leaf + 1] - cut[leaf]))
    part, i = np.divmod(i, pairs[group])  # a part's entries lie together
    place, pair = cut[leaf[group]] + part, begins[group] + i
    apart = points[pos[pair], place] - entries[pos[pair], entry[pair]]
    first = np.flatnonzero(i == 0)
    if not len(first):
        return pos, node, entry
    best = np.minimum.reduceat((apart * apart).sum(axis=1) * count + entry[pair], first)
    return pos[pair][first], place[first], best % count


def part_sums(tree: Tree, points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray, book: EntryTree) -> np.ndarray:
    """For each position and entry the sum of its parts, and their number as a last component."""
    whole, single = assign(tree, points, low, high, book)
    positions, entries, width = book.entries.shape
    total = np.zeros((positions * entries, width + 1), np.int64)
    for pos, level, node, entry in whole:
        cell = pos * entries + entry
        np.add.at(total[:, :width], cell, sums[pos, (1 << level) - 1 + node])
        np.add.at(total[:, width], cell, ((node + 1) * tree.n >> level) - (node * tree.n >> level))
    for pos, place, entry in single:
        cell = pos * entries + entry
        np.add.at(total[:, :width], cell, points[pos, place])
        np.add.at(total[:, width], cell, 1)
    return total


def nearest(tree: Tree, points: np.ndarray, low: np.ndarray, high: np.ndarray, book: EntryTree) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every part, arrays (position, place)."""
    whole, single = assign(tree, points, low, high, book)
    code = np.zeros(points.shape[:2], np.int64)
    for pos, level, node, entry in whole:
        begin, end = node * tree.n >> level, (node + 1) * tree.n >> level
        held, i = spread(end - begin)
        code[pos[held], begin[held] + i] = entry[held]
    for pos, place, entry in single:
        code[pos, place] = entry
    apart = points - np.take_along_axis(book.entries, code[:, :, None], axis=1)
    return code, (apart * apart).sum(axis=2)


# -- over all blocks ----------------------------------------------------------


def bound(width: int) -> int:
    """The size that components are held to, so that squared distances and their sums fit 64 bits."""
    return 1 << (29 - (max(width, 1).bit_length() + 1) // 2)


def blocks(spark: SparkSession, rows: DataFrame, positions: int, width: int) -> DataFrame:
    """The staged blocks of rows (vec_id, label, v): their parts in the order of each position's tree, its boxes and sums."""
    most = bound(width)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, BLOCK_ROWS):
                values = np.clip(part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64), -most, most)
                n = part.num_rows
                points = np.ascontiguousarray(values.reshape(n, positions, -1).transpose(1, 0, 2))
                tree = Tree(n, LEAF)
                places = tree.order(points)
                points = np.take_along_axis(points, places[:, :, None], axis=1)
                low, high = boxes(tree, points)
                sums = tree.levels(points, np.add)
                listed = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(c)) for c in ("vec_id", "label")]
                packed = [points.astype(np.int32), places.astype(np.uint16), low.astype(np.int32), high.astype(np.int32), sums]
                yield pa.RecordBatch.from_arrays(
                    [*listed, pa.array([n], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in packed]],
                    ["ids", "labels", "n", "parts", "places", "low", "high", "sums"],
                )

    types = {"id": rows.schema["vec_id"].dataType.simpleString(), "label": rows.schema["label"].dataType.simpleString()}
    return common.stage(spark, rows.mapInArrow(build, BLOCK_SCHEMA.format(**types)), "part-trees")


def unpacked(block: dict, positions: int) -> tuple:
    """(tree, points, places, low, high, sums) of a staged block."""
    n = block["n"]

    def read(name: str, kind: type, count: int) -> np.ndarray:
        return np.frombuffer(block[name], kind).astype(np.int64).reshape(positions, count, -1)

    tree = Tree(n, LEAF)
    nodes = (2 << tree.depth) - 1
    return (tree, read("parts", np.int32, n), read("places", np.uint16, n)[:, :, 0], read("low", np.int32, nodes),
            read("high", np.int32, nodes), read("sums", np.int64, nodes))


def each(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in columns}


TREE = ["n", "parts", "places", "low", "high", "sums"]


def sums_of(held: DataFrame, entries: np.ndarray) -> np.ndarray:
    """One pass: sums and numbers (position, entry, component + 1) of the parts that each entry is nearest to."""
    positions, count, width = entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, total = EntryTree(entries), None
        for block in each(batches, TREE):
            tree, points, _, low, high, sums = unpacked(block, positions)
            got = part_sums(tree, points, low, high, sums, book)
            total = got if total is None else total + got
        if total is not None:
            part, body = zip(*common.table_rows(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(body, pa.binary())], ["part", "body"])

    total = common.add_tables(held.select(*TREE).mapInArrow(add, common.SUM_SCHEMA), positions * count * (width + 1), "int64")
    return total.reshape(positions, count, width + 1)


def first_entries(rows: DataFrame, positions: int, count: int, width: int) -> np.ndarray:
    """The parts of the ``count`` smallest ids, equal ids by their vectors, as (position, entry, component)."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(count).collect()
    values = np.array([r["v"] for r in least], np.int64).reshape(len(least), positions, -1)
    return np.ascontiguousarray(np.clip(values, -bound(width), bound(width)).transpose(1, 0, 2))


def with_label_errors(spark: SparkSession, coded: DataFrame, total: int) -> DataFrame:
    """``label_error`` beside each row.  Labels that more than a thousandth of the rows share are at most a
    thousand, so that their sums can be broadcast; the others' are joined by label, and no task gets a frequent one."""
    sums = common.stage(spark, coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")), "label-errors")
    hot = sums.where(F.col("rows") * HOT_LABELS > total).select(F.col("label").alias("hot"), F.col("label_error").alias("hot_error"))
    rare = sums.where(F.col("rows") * HOT_LABELS <= total).select(F.col("label").alias("rare"), F.col("label_error").alias("rare_error"))
    rows = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("hot")), "left")
    frequent = rows.where(F.col("hot_error").isNotNull()).withColumn("label_error", F.col("hot_error"))
    others = rows.where(F.col("hot_error").isNull()).join(rare, F.col("label").eqNullSafe(F.col("rare")))
    names = ["vec_id", "code", "error", "label_error"]
    return frequent.select(*names).union(others.withColumn("label_error", F.col("rare_error")).select(*names))


def vector_codes(spark: SparkSession, df: DataFrame, positions: int = 16, entries: int = 64, rounds: int = 2, factor: int = 256,
                 vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: one row per vector that takes part.

    Vectors that are null or hold null, NaN or infinite components take no part, nor do those of another
    length than the vector of the smallest id.  A length that doesn't divide into ``positions``, or is 0, is
    filled up with zeros.  Components are floors of ``factor`` times the
    given ones, held to +-``bound`` (2^25 for 64).  Equal ids are told apart by their vectors when the first entries are
    taken, null ids come last.  Repeated rows are rows of their own.  With fewer vectors than ``entries`` the
    codebooks are as small.  Null labels are one label.  An empty table gives an empty result.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has to fit a byte")
    names = df.columns
    given = common.numbered(df)
    rows = whole_vectors(
        given.select(F.struct(*[f"c{names.index(c)}" for c in (vec_id, label)]).alias("vec_id"), F.col(f"c{names.index(vector)}").alias("embedding")),
        "vec_id", "embedding", factor,
    ).select(F.col(f"vec_id.c{names.index(vec_id)}").alias("vec_id"), F.col(f"vec_id.c{names.index(label)}").alias("label"), "v")
    out = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, code string, error long, label_error long, codebooks_sha256 string"
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("n")).first()
    if least is None:
        return spark.createDataFrame([], out)
    width = -(-max(least["n"], 1) // positions) * positions
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width - least["n"])))
    rows = rows.where(F.size("v") == least["n"]).withColumn("v", filled)
    held = blocks(spark, rows, positions, width)
    book = first_entries(rows, positions, entries, width)
    for _ in range(rounds):
        total = sums_of(held, book)
        number = total[:, :, -1:]
        book = np.where(number > 0, total[:, :, :-1] // np.maximum(number, 1), book)
    digest = sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    types = {f.name: f.dataType.elementType.simpleString() for f in held.schema.fields[:2]}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tried = EntryTree(book)
        for batch in batches:
            ids, labels = batch.column("ids"), batch.column("labels")
            for i, block in enumerate(each(iter([batch]), TREE)):
                tree, points, places, low, high, _ = unpacked(block, positions)
                code, error = nearest(tree, points, low, high, tried)
                # from the order of the trees to that of the rows
                back = np.argsort(places, axis=1)
                code, error = np.take_along_axis(code, back, axis=1), np.take_along_axis(error, back, axis=1)
                text = [bytes(c).hex() for c in code.T.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [ids[i].values, labels[i].values, pa.array(text, pa.string()), pa.array(error.sum(axis=0), pa.int64())],
                    ["vec_id", "label", "code", "error"],
                )

    coded = held.mapInArrow(encode, f"vec_id {types['ids']}, label {types['labels']}, code string, error long")
    coded = common.stage(spark, coded, "codes")
    return with_label_errors(spark, coded, coded.count()).withColumn("codebooks_sha256", F.lit(digest))
