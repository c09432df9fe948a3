"""Op 3: shards by minimax contiguous partition of ordered groups.

Equal texts are one atomic group; groups are ordered by the MD5 of their text.  The law is
``bytes``: the largest shard is as small as any cut of that order into ``shards`` runs allows.  The
smallest feasible capacity is found by binary search; a capacity is checked greedily, filling
each shard as far as it goes, and the greedy cuts of the smallest one are taken.

The groups are not collected.  The driver sees sizes by key prefix, a tree of which only those
nodes are opened in which a cut can lie; closed nodes give a lower bound (they could be cut
anywhere) and an upper bound (they can't be cut), and the search ends when both agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

#: Hexadecimal digits of the first level of the tree, and of each further one.
FIRST, FURTHER = 3, 2


@dataclass
class Node:
    prefix: str
    size: int
    atomic: bool


def greedy(sizes: np.ndarray, atomic: np.ndarray, capacity: int, shards: int, whole: bool) -> list[tuple[int, int]]:
    """Ends of the filled shards as (node, bytes of it taken); whole: no node may be cut."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    node, part, out = 0, 0, []
    for _ in range(shards):
        reach = int(total[node]) + part + capacity
        at = int(np.searchsorted(total, reach, "right")) - 1  # nodes that end within reach
        if at >= len(sizes):
            node, part = len(sizes), 0
        elif at < node:  # the node that was cut reaches further
            part = part + capacity
        else:
            node, part = at, 0 if whole or atomic[at] else reach - int(total[at])
        out.append((node, part))
    return out


def smallest(sizes: np.ndarray, atomic: np.ndarray, shards: int, whole: bool) -> int:
    """The smallest capacity that the greedy check finds feasible."""
    lo, hi = 0, int(sizes.sum())
    while lo < hi:
        mid = (lo + hi) // 2
        if greedy(sizes, atomic, mid, shards, whole)[-1][0] >= len(sizes):
            hi = mid
        else:
            lo = mid + 1
    return lo


def cuts(rows: DataFrame, shards: int) -> tuple[list[str], int]:
    """(key prefixes at which shards 1, 2, .. begin, capacity); rows: key, size."""

    def opened(prefixes: list[str] | None, digits: int) -> list[Node]:
        prefix = F.substring("key", 1, digits)
        part = rows if prefixes is None else rows.where(F.substring("key", 1, len(prefixes[0])).isin(prefixes))
        got = part.groupBy(prefix.alias("p")).agg(F.sum("size").alias("size"), (F.min("key") == F.max("key")).alias("atomic"))
        return [Node(r["p"], r["size"], r["atomic"]) for r in sorted(got.collect(), key=lambda r: r["p"])]

    nodes = opened(None, FIRST)
    while True:
        sizes = np.array([n.size for n in nodes], np.int64)
        atomic = np.array([n.atomic for n in nodes], bool)
        low, high = smallest(sizes, atomic, shards, False), smallest(sizes, atomic, shards, True)
        first = greedy(sizes, atomic, low, shards, True)
        last = greedy(sizes, atomic, high, shards, False)
        within = set()
        for (a, _), (b, _) in zip(first, last):
            within.update(range(a, min(b + 1, len(nodes))))
        within = {i for i in within if not nodes[i].atomic}
        if low == high and not any(i in within for i, _ in greedy(sizes, atomic, high, shards, False)):
            ends = greedy(sizes, atomic, high, shards, True)
            return [nodes[i].prefix if i < len(nodes) else "~" for i, _ in ends[:-1]], high
        by_length: dict[int, list[str]] = {}
        for i in within:
            by_length.setdefault(len(nodes[i].prefix), []).append(nodes[i].prefix)
        kept = [n for i, n in enumerate(nodes) if i not in within]
        for length, prefixes in by_length.items():
            kept += opened(sorted(prefixes), length + FURTHER)
        nodes = sorted(kept, key=lambda n: n.prefix)


def shard(spark: SparkSession, df: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, capacity``.

    ``slot`` numbers a shard's rows from 0 without gaps, by key and doc_id.  A null text has size 1 and the
    checksum of an empty one, and is in one group with empty texts.  Repeated rows are rows of their own.
    With fewer groups than shards some shards are empty; an empty table gives an empty result.
    """
    body = F.coalesce("text", F.lit("")).cast("binary")
    rows = common.pick(df, doc_id=doc_id, text=text).select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.md5(body).alias("key")
    )
    # in order of key, so that every shard is a run of rows; the order is written once and then numbered
    ordered = rows.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id")
    ordered = common.stage(spark, ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    begins, capacity = cuts(ordered, shards)
    number = sum([(F.col("key") >= b).cast("int") for b in begins], F.lit(0))
    # a partition's part of a shard is a run: its first place and length give every row its slot
    placed = ordered.withColumn("shard", number).withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()
    offsets, done = [], {}
    for r in sorted(runs, key=lambda r: (r["shard"], r["part"])):
        offsets.append((r["shard"], r["part"], done.get(r["shard"], 0) - r["first"]))
        done[r["shard"]] = done.get(r["shard"], 0) + r["n"]
    # one entry for each partition and shard in it: at most partitions + shards of them
    shifts = spark.createDataFrame(offsets, "shard int, part bigint, shift bigint")
    return placed.join(F.broadcast(shifts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("at") + F.col("shift")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.lit(capacity).cast("long").alias("capacity"),
    )
