"""Op 4: n-gram Jaccard join with token-combination prefixes.

Two texts link when their sets of word shingles have a Jaccard similarity of at least
``percent`` / 100.  Texts with the same set are one class; the join works on classes.

* Every shingle gets a rank: how many texts have it, counted over the whole corpus in a table
  of fixed size (so rare and frequent shingles are told apart), then its hash.
* A set may lose at most ``allowed`` of its shingles to a partner.  Its prefix - the rarest
  shingles - is extended until no loss of ``allowed`` shingles can break all signatures: a rare
  shingle is a signature by itself; shingles of the frequent class are dealt into small
  sub-classes and signed by pairs (k = 2), of which n shingles give cover n - 1.
* Classes that share a signature are candidates.  They meet first around one centre for each
  signature; what is still apart is then compared block by block.  Pairs that are already
  in one component are not compared again, so a group of near copies costs a star, not all pairs.
* A parity bitmap of each set bounds the overlap from above and drops most candidates; the
  others are verified with their whole sets.

Shingles and sets are compared by 64-bit hashes (a corpus of N sets has about N**2 / 2**65
colliding pairs).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common, words
from .components import components

U = np.uint64
#: Entries of the table that counts shingles, and of the one that marks wanted rows.
COUNT_BITS = 18
MARK_BITS = 22
#: A shingle is of the frequent class from so many times the table's mean count on.
FREQUENT = 4
#: Members of a signature that are compared in one go; larger signatures are dealt into parts of this size.
PART = 1024


def least_overlap(size: np.ndarray | int, percent: int):
    """Shingles that a set of this size shares with any partner, at least."""
    return -(-size * percent // 100)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in common.slices(batch):
            out = [np.empty(0, U)] * part.num_rows
            for i, hashes in words.documents(part.column("text"), words.SPACES):
                out[i] = words.shingles(hashes, width)
            yield part, out


def _count(rows: DataFrame, width: int) -> DataFrame:
    """rid, n, cls of every row, and (part, body) rows of each task's shingle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        names = ["rid", "n", "cls", "part", "body"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for part, sets in _sets(batches, width):
            merged = np.concatenate([*sets, np.empty(0, U)])
            counts += np.bincount((merged >> U(64 - COUNT_BITS)).astype(np.int64), minlength=len(counts))
            cls = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
            none = pa.nulls(len(sets))
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), pa.array([len(s) for s in sets], types[1]), pa.array(cls, types[2]), none.cast(types[3]), none.cast(types[4])], names
            )
        if got := list(common.table_rows(counts)):
            none = pa.nulls(len(got), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.array([g[0] for g in got], types[3]), pa.array([g[1] for g in got], types[4])], names
            )

    return rows.mapInArrow(run, "rid bigint, n bigint, cls bigint, part int, body binary")


def signatures(shingles: np.ndarray, counts: np.ndarray, frequent: float, percent: int, bucket: int) -> np.ndarray:
    """The signatures of one set among sets of 2**(bucket-1) to 2**bucket - 1 shingles."""
    n = len(shingles)
    need = n - int(least_overlap(n, percent)) + 1
    df = counts[(shingles >> U(64 - COUNT_BITS)).astype(np.int64)]
    order = np.lexsort((shingles, df))
    ranked, df = shingles[order], df[order]
    classes = (1 << bucket >> 1) // 4
    often = (df > frequent) if classes >= 2 else np.zeros(n, bool)
    sub = np.where(often, (words.mix(ranked + U(bucket)) % U(max(classes, 1))).astype(np.int64), -1)
    # cover of each further shingle: none for the first one of a sub-class
    gain = np.ones(n, np.int64)
    seen = np.flatnonzero(often)
    gain[seen[np.unique(sub[seen], return_index=True)[1]]] = 0
    prefix = min(n, int(np.searchsorted(np.cumsum(gain), need)) + 1)
    ranked, sub, often = ranked[:prefix], sub[:prefix], often[:prefix]
    out = [ranked[~often]]
    if often.any():
        by = np.lexsort((ranked[often], sub[often]))
        token, group = ranked[often][by], sub[often][by]
        for d in range(1, len(token)):
            same = np.flatnonzero(group[d:] == group[:-d])
            if not len(same):
                break
            out.append(words.mix(token[same] * words.BASE + token[same + d]))
    return words.mix(np.unique(np.concatenate(out)) + U(bucket * int(words.BASE) % (1 << 64)))


def bitmap(shingles: np.ndarray, bucket: int) -> np.ndarray:
    """Parity of the shingles over 2**bucket bits (64 at least)."""
    bits = max(bucket, 6)
    parity = (np.bincount((words.mix(shingles) >> U(64 - bits)).astype(np.int64), minlength=1 << bits) & 1).astype(np.uint8)
    return np.packbits(parity)


def buckets(n: int, percent: int) -> set[int]:
    """Size buckets under which a set is filed: its own, and that of its largest partner."""
    return {n.bit_length(), (n * 100 // percent).bit_length()}


def _index(spark: SparkSession, rows: DataFrame, counts: np.ndarray, width: int, percent: int) -> DataFrame:
    """cls, n, sigs, bm: one row for each text and bucket."""
    frequent = FREQUENT * float(counts.mean())
    shared = spark.sparkContext.broadcast(counts.astype(np.int32 if counts.max(initial=0) < 1 << 31 else np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for _, sets in _sets(batches, width):
            cls, n, sigs, bms = [], [], [], []
            for s in sets:
                if len(s):
                    name = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                    for bucket in buckets(len(s), percent):
                        cls.append(name)
                        n.append(len(s))
                        sigs.append(signatures(s, counts, frequent, percent, bucket).view(np.int64))
                        bms.append(bitmap(s, bucket).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls, pa.int64()), pa.array(n, pa.int64()), pa.array(sigs, pa.list_(pa.int64())), pa.array(bms, pa.binary())],
                ["cls", "n", "sigs", "bm"],
            )

    return rows.mapInArrow(run, "cls bigint, n bigint, sigs array<bigint>, bm binary")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by gid, cut between groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        gid = batch.column("gid").to_numpy()
        cut = int(np.searchsorted(gid, gid[-1], "left"))  # the last group may go on in the next batch
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _stars(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows (gid, cls, n, len) sorted by gid: the pairs (a, b, len) of each group's first row and another
    that their sizes allow to link."""
    for table in _groups(batches):
        gid, cls, n, length = (table.column(c).to_numpy() for c in ("gid", "cls", "n", "len"))
        first = np.searchsorted(gid, gid, "left")
        ok = (cls != cls[first]) & (length == length[first])
        ok &= 100 * np.minimum(n, n[first]) >= percent * np.maximum(n, n[first])
        x, y = cls[first[ok]], cls[ok]
        got = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y), length[ok].astype(np.int64)], 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1]), pa.array(got[:, 2], pa.int32())], ["a", "b", "len"])


def _alike(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, len), those (a, b) whose bitmaps allow a link."""
    both = pairs
    for side in ("a", "b"):
        of = maps.select(F.col("cls").alias(side), "len", F.col("n").alias(f"n_{side}"), F.col("bm").alias(f"bm_{side}"))
        both = both.join(of, [side, "len"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, 4096):
                n = part.column("n_a").to_numpy() + part.column("n_b").to_numpy()
                length = part.column("len").to_numpy()
                left, right = (part.column(c).to_pylist() for c in ("bm_a", "bm_b"))
                apart = np.zeros(len(n), np.int64)
                for size in np.unique(length).tolist():
                    at = np.flatnonzero(length == size)
                    x, y = (np.frombuffer(b"".join([m[i] for i in at]), U).reshape(len(at), -1) for m in (left, right))
                    apart[at] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
                most = (n - apart) // 2  # of the overlap
                yield part.select(["a", "b"]).filter(pa.array(100 * most >= percent * (n - most)))

    return both.select("a", "b", "len", "n_a", "n_b", "bm_a", "bm_b").mapInArrow(run, "a bigint, b bigint")


def _near(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of rows sorted by gid: (gid, side, cls, comp, n, bm); links of each batch once.

    side 2: all pairs of the group; otherwise pairs of different sides.  Pairs in one component,
    or whose bitmaps or sizes rule a link out, are left out.
    """

    def pairs(table: pa.Table) -> pa.RecordBatch:
        gid, side, cls, comp, n = (table.column(c).to_numpy() for c in ("gid", "side", "cls", "comp", "n"))
        bodies = table.column("bm").to_pylist()
        length = np.array([len(b) for b in bodies])
        place = np.zeros(len(bodies), np.int64)
        maps = {}
        for size in np.unique(length).tolist():
            rows = np.flatnonzero(length == size)
            place[rows] = np.arange(len(rows))
            maps[size] = np.frombuffer(b"".join([bodies[i] for i in rows]), U).reshape(len(rows), -1)
        out: list[np.ndarray] = []

        def test(left: np.ndarray, right: np.ndarray) -> None:
            small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
            ok = (comp[left] != comp[right]) & (100 * small >= percent * large) & (length[left] == length[right])
            ok &= (side[left] != side[right]) | (side[left] == 2)
            left, right = left[ok], right[ok]
            for size in np.unique(length[left]).tolist():
                of = np.flatnonzero(length[left] == size)
                step = max(1, (1 << 22) // size)
                for lo in range(0, len(of), step):
                    x, y = left[of[lo : lo + step]], right[of[lo : lo + step]]
                    apart = np.bitwise_count(maps[size][place[x]] ^ maps[size][place[y]]).sum(1, dtype=np.int64)
                    most = (n[x] + n[y] - apart) // 2  # of the overlap
                    fit = 100 * most >= percent * (n[x] + n[y] - most)
                    out.append(np.stack([np.minimum(cls[x[fit]], cls[y[fit]]), np.maximum(cls[x[fit]], cls[y[fit]])], 1))

        at, d = np.arange(len(gid)), 1
        while len(at := at[at + d < len(gid)]) and len(at := at[gid[at] == gid[at + d]]):
            test(at, at + d)
            d += 1
        got = np.unique(np.concatenate([np.empty((0, 2), np.int64), *out]), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["a", "b"])

    for table in _groups(batches):
        yield pairs(table)


def _marked(spark: SparkSession, wanted: DataFrame) -> np.ndarray:
    """A table of fixed size in which every wanted rid is marked (others may be, too)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(1 << MARK_BITS, np.uint8)
        for batch in batches:
            marks[(words.mix(batch.column("rid").to_numpy().astype(U)) >> U(64 - MARK_BITS)).astype(np.int64)] = 1
        got = list(common.table_rows(marks))
        yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int32()), pa.array([np.packbits(np.frombuffer(g[1], np.uint8)).tobytes() for g in got], pa.binary())], ["part", "body"])

    import pandas as pd

    def joined(keys, frame):
        total = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in frame["body"]])
        return pd.DataFrame({"part": [keys[0]], "body": [total.tobytes()]})

    marks = np.zeros(1 << MARK_BITS, np.uint8)
    rows = wanted.mapInArrow(run, common.SUM_SCHEMA).withColumn("sub", F.spark_partition_id() % 16)
    rows = rows.groupBy("part", "sub").applyInPandas(joined, common.SUM_SCHEMA).groupBy("part").applyInPandas(joined, common.SUM_SCHEMA)
    for row in rows.collect():
        got = np.unpackbits(np.frombuffer(row["body"], np.uint8))
        marks[row["part"] * common.CHUNK : row["part"] * common.CHUNK + len(got)] = got
    return marks


def _verified(spark: SparkSession, rows: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of candidate pairs (a, b), those that link; the whole sets are compared."""
    pairs = common.stage(spark, pairs.distinct(), "candidates")
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct().join(classes, "cls").select("cls", "rid")
    wanted = common.stage(spark, wanted, "wanted")
    shared = spark.sparkContext.broadcast(np.packbits(_marked(spark, wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.unpackbits(shared.value).astype(bool)

        def some() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = (words.mix(batch.column("rid").to_numpy().astype(U)) >> U(64 - MARK_BITS)).astype(np.int64)
                yield batch.filter(pa.array(marks[at]))

        for part, sets in _sets(some(), width):
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["rid", "shingles"]
            )

    sets = rows.mapInArrow(run, "rid bigint, shingles array<bigint>").join(wanted, "rid").select("cls", "shingles")
    sets = common.stage(spark, sets, "sets")
    both = pairs.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b").join(
        sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), "a"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sa, sb = batch.column("sa"), batch.column("sb")
            for i in range(batch.num_rows):
                x, y = sa[i].values.to_numpy(), sb[i].values.to_numpy()
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a bigint, b bigint")


def classes_joined(spark: SparkSession, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """For rows (rid unique, text): rid, n (shingles of its set), cls, root (class of its component; null: no shingle)."""
    counted = common.stage(spark, _count(rows, width), "counted")
    counts = common.add_tables(counted.where("part is not null").select("part", "body"), 1 << COUNT_BITS, "int64")
    each = counted.where("rid is not null").select("rid", "n", "cls")
    classes = each.where("n > 0").groupBy("cls").agg(F.min("rid").alias("rid"))
    index = common.stage(spark, _index(spark, rows, counts, width, percent), "index")
    entries = index.select("cls", "n", F.explode("sigs").alias("sig"), F.octet_length("bm").alias("len"))
    often = entries.groupBy("sig").agg(F.count("*").alias("members")).where("members > 1")
    # staged alone, so that its shuffle is gone before the entries themselves are shuffled
    often = common.stage(spark, often.select("sig"), "shared-signatures")
    # members of shared signatures; copies of one set count once
    met = entries.join(often, "sig").select("sig", "cls", "n", "len").distinct()
    sizes = met.groupBy("sig").agg(F.count("*").alias("members")).where("members > 1")
    met = common.stage(spark, met.join(sizes, "sig"), "met")
    # the centre of a signature: the class with the most shared signatures for its size, thus the fewest own words
    weight = met.groupBy("cls").agg((F.count("*") / F.max("n")).alias("weight"))
    met = common.stage(spark, met.join(weight, "cls"), "met-weights")
    # the bitmaps, once for each class: stars are shuffled without them
    maps = index.groupBy("cls", F.octet_length("bm").alias("len")).agg(F.first("n").alias("n"), F.first("bm").alias("bm"))
    maps = common.stage(spark, maps, "maps")

    links, comp = None, None
    parts = F.ceil(F.col("members") / PART).cast("int")
    for star in (True, False):
        if star:
            known = met.withColumn("gid", F.xxhash64("sig", F.pmod(F.xxhash64("cls"), parts).cast("int")))
            known = known.select("gid", "weight", "cls", "n", "len").repartition("gid").sortWithinPartitions("gid", F.desc("weight"), "cls")
            stars = known.mapInArrow(lambda batches: _stars(batches, percent), "a bigint, b bigint, len int")
            near = _alike(stars.distinct(), maps, percent)
        else:
            known = met.join(comp.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("comp", F.coalesce("root", "cls"))
            # signatures whose members are not all in one component yet
            open_ = known.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi")
            known = known.join(open_.select("sig"), "sig").join(maps.select("cls", "len", "bm"), ["cls", "len"])
            known = known.withColumn("mine", F.pmod(F.xxhash64("cls"), parts).cast("int"))
            known = known.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).select(
                "*",
                F.xxhash64("sig", F.least("mine", "other"), F.greatest("mine", "other")).alias("gid"),
                F.when(F.col("mine") == F.col("other"), 2).otherwise((F.col("mine") > F.col("other")).cast("int")).alias("side"),
            )
            known = known.select("gid", F.col("side").cast("int").alias("side"), "cls", "comp", "n", "bm").repartition("gid")
            known = known.sortWithinPartitions("gid", "cls")
            near = known.mapInArrow(lambda batches: _near(batches, percent), "a bigint, b bigint")

        found = _verified(spark, rows, classes, near, width, percent)
        links = found if links is None else links.unionByName(found)
        links = common.stage(spark, links, "linked")
        comp = components(spark, links)
    return each.join(comp.select(F.col("node").alias("cls"), "root"), "cls", "left").select(
        "rid", "n", "cls", F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("root")
    )


def decisions(spark: SparkSession, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """For rows (rid unique, doc_id, text): rid, doc_id, n_shingles, component_id, first (one row of each component)."""
    joined = classes_joined(spark, rows.select("rid", "text"), width, percent)
    each = common.stage(spark, joined.join(rows.select("rid", "doc_id"), "rid"), "joined")
    low = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "rid")
    least = each.where("root is not null").groupBy("root").agg(F.min(low).alias("low"))
    return each.join(least, "root", "left").select(
        "rid", "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("low.doc_id")).alias("component_id"),
        (F.col("root").isNull() | (F.col("low.rid") == F.col("rid"))).alias("first"),
    )


def jaccard_join(spark: SparkSession, df: DataFrame, width: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    A text with fewer than ``width`` words has its whole sequence as one shingle; a null or empty
    text has none and links with nothing (its component is its own id, repeated rows included).
    Repeated rows with words share their component.  A null doc_id comes after all others.
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = common.row_ids(spark, common.pick(df, doc_id=doc_id, text=text))
    return decisions(spark, rows, width, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each(spark: SparkSession, df: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of which one of each component stays (smallest doc_id), with all their columns."""
    kept, restore = common.tracked(spark, df, doc_id, text)
    decided = decisions(spark, kept.select("rid", "doc_id", "text"), width, percent)
    return restore(kept.join(decided.where("not first").select("rid"), "rid", "left_anti"))
