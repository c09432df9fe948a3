"""Op 12: exact top-k search by no-random-access aggregation.

The score of a query and a candidate is the inner product of their integer vectors, a sum with one
term for each dimension.  Candidates are kept in blocks; a block holds one list for each dimension, its
rows in ascending order of that component.  A query reads every list from the end that suits its
sign, so that terms come largest first, down to a common level ``t`` that is lowered step by step.
What has been read of a row gives its known sum and how many lists it was met in; a list in which it
wasn't met yet owes it at most ``t`` and at least that list's last term.  Rows whose upper bound lies
below the k-th largest lower bound can't qualify and go; once few are left, the lists are read on for
those alone, to their ends, which gives the final scores.  No component is ever looked up by its row.

All queries meet all blocks, in units of a bounded number of both; a query's bound is carried
from block to block of a unit, and the units' best rows are merged by a ranking window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import common

#: Rows of a block, and blocks of a unit on average.  The places in a block's lists are 16-bit numbers.
BLOCK_ROWS, UNIT_BLOCKS = 8192, 8
#: Queries of a unit: as many as deal them into this number of packs, within these bounds.
LEAST_PACK, MOST_PACK, PACKS = 32, 16384, 64
#: Terms kept of each list of a block, to choose levels by.
MARKS = 33
#: Shares of a block's terms after which bounds are compared, the last one being all of them.
DEPTHS = (0.4, 0.5, 0.7, 0.9, 1.0)
#: Numbers below this size are exact as doubles, with room for quotients; beyond it Python's integers are used.
EXACT = 1 << 50
#: The scores that a result can hold.
LEAST, LARGEST = -(1 << 63), (1 << 63) - 1

BLOCK_SCHEMA = "block long, dim int, ids array<{id}>, kind string, places binary, terms binary, levels binary"
QUERY_SCHEMA = "row long, dim int, query_id {id}, kind string, vector binary"
BEST_SCHEMA = "query long, query_id {id}, vec_id {id}, score long"


def whole_vectors(df: DataFrame, vec_id: str, vector: str, factor: int) -> DataFrame:
    """Columns vec_id and v, the floors of ``factor`` times each component; rows without a whole finite vector go."""
    rows = common.pick(df, vec_id=vec_id, v=vector).withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("v").isNotNull() & finite).withColumn("v", F.transform("v", lambda x: F.floor(x * factor)))


def smallest_kind(values: np.ndarray) -> str:
    top = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
    return "i2" if top < 1 << 15 else "i4" if top < 1 << 31 else "i8"


def sorted_lists(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, terms), one list a dimension: the rows in ascending order of their component, and the components."""
    places = np.argsort(matrix.T, axis=1, kind="stable")
    return places.astype(np.uint16), np.take_along_axis(matrix.T, places, axis=1)


def blocks(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The staged blocks of rows (vec_id, v), vectors of one length in each."""
    id_type = rows.schema["vec_id"].dataType

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 26
        waiting: dict[int, list] = {}

        def made(dim: int, parts: list) -> pa.RecordBatch:
            nonlocal number
            ids = pa.concat_arrays([p[0] for p in parts])
            matrix = np.concatenate([p[1] for p in parts])
            kind = smallest_kind(matrix)
            places, terms = sorted_lists(matrix)
            marks = np.linspace(0, len(matrix) - 1, MARKS).astype(int)
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([dim], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([kind]), pa.array([places.tobytes()], pa.binary()),
                 pa.array([terms.astype(kind).tobytes()], pa.binary()), pa.array([terms[:, marks].astype(kind).tobytes()], pa.binary())],
                ["block", "dim", "ids", "kind", "places", "terms", "levels"],
            )

        for batch in batches:
            for part in common.slices(batch, BLOCK_ROWS):
                lists, ids = part.column("v"), part.column("vec_id")
                lengths = np.diff(lists.offsets.to_numpy())
                values = lists.flatten().to_numpy(zero_copy_only=False)
                starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
                for dim in np.unique(lengths).tolist():
                    at = np.flatnonzero(lengths == dim)
                    matrix = values[starts[at][:, None] + np.arange(dim)].astype(np.int64)
                    held = waiting.setdefault(dim, [])
                    held.append((ids.take(pa.array(at)), matrix))
                    if sum(len(p[0]) for p in held) >= BLOCK_ROWS:
                        ids_, matrix_ = pa.concat_arrays([p[0] for p in held]), np.concatenate([p[1] for p in held])
                        for lo in range(0, len(ids_) - BLOCK_ROWS + 1, BLOCK_ROWS):
                            yield made(dim, [(ids_[lo : lo + BLOCK_ROWS], matrix_[lo : lo + BLOCK_ROWS])])
                        rest = len(ids_) % BLOCK_ROWS
                        waiting[dim] = [(ids_[len(ids_) - rest :], matrix_[len(ids_) - rest :])] if rest else []
        for dim, parts in waiting.items():
            if parts:
                yield made(dim, parts)

    # small partitions would make small blocks
    rows = rows.coalesce(max(1, rows.count() // (4 * BLOCK_ROWS)))
    return common.stage(spark, rows.mapInArrow(build, BLOCK_SCHEMA.format(id=id_type.simpleString())), "lists")


def whole(numbers: np.ndarray) -> np.ndarray:
    """As Python's integers."""
    return numbers if numbers.dtype == object else numbers.astype(np.int64).astype(object)


def queries_of(spark: SparkSession, lists: DataFrame, modulus: int) -> DataFrame:
    """The rows of the blocks whose id is divisible: ``row`` is block and place in it, so that a query knows its own row."""
    id_type = lists.schema["ids"].dataType.elementType

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                at = [i for i, x in enumerate(b["ids"]) if x is not None and x % modulus == 0]
                shape = b["dim"], len(b["ids"])
                places = np.frombuffer(b["places"], np.uint16).reshape(shape)
                terms = np.frombuffer(b["terms"], b["kind"]).reshape(shape)
                matrix = np.empty(shape[::-1], b["kind"])
                np.put_along_axis(matrix.T, places.astype(np.int64), terms, axis=1)
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([(b["block"] << 16) + i for i in at], pa.int64()),
                    "dim": pa.array([b["dim"]] * len(at), pa.int32()),
                    "query_id": pa.array([b["ids"][i] for i in at], batch.schema.field("ids").type.value_type),
                    "kind": pa.array([b["kind"]] * len(at), pa.string()),
                    "vector": pa.array([matrix[i].tobytes() for i in at], pa.binary()),
                })

    return common.stage(spark, lists.mapInArrow(take, QUERY_SCHEMA.format(id=id_type.simpleString())), "topk-queries")


def one_term(dim: int) -> int:
    """What sums are multiplied by, so that a count of up to ``dim`` lists fits beside them in one number."""
    return 1 << int(dim).bit_length()


def best_in_block(query: np.ndarray, places: np.ndarray, terms: np.ndarray, levels: np.ndarray, k: int, floor, without: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the block's rows that can be among the k best, scores exact.

    ``without`` is the place of the query's own row, or -1.  ``floor`` is a score that k rows are known to
    reach, or None.  All numbers are whole; their type is one that holds every sum exactly.
    """
    dim, n = terms.shape
    live = np.flatnonzero(query)  # a list whose factor is 0 owes every row nothing
    up = query > 0
    ends = np.where(up, terms[:, -1], terms[:, 0]) * query
    lasts = np.where(up, terms[:, 0], terms[:, -1]) * query
    read = np.zeros(dim, np.int64)  # terms read of each list, from the end that suits the sign
    unit = one_term(dim)
    met = np.zeros(n, terms.dtype)  # of each row, the known sum times the unit, and the number of lists it was met in
    alive = np.ones(n, bool)
    if without >= 0:
        alive[without] = False
    ladder = np.sort((levels[live] * query[live][:, None]).ravel())[::-1]
    few = False
    for depth in DEPTHS:
        level = ladder[min(int(depth * len(ladder)), len(ladder) - 1)] if len(ladder) else 0
        rows, parts = [], []
        for j in live:
            if depth == 1.0:
                upto = n
            elif up[j]:
                upto = n - terms[j].searchsorted(-(-level // query[j]), "left")
            else:
                upto = terms[j].searchsorted(level // query[j], "right")
            if upto > read[j]:
                cut = slice(n - upto, n - read[j]) if up[j] else slice(read[j], upto)
                rows.append(places[j, cut])
                parts.append(terms[j, cut] * (query[j] * unit) + 1)
                read[j] = upto
        if rows:
            row, part = np.concatenate(rows), np.concatenate(parts)
            if few:
                keep = alive[row]
                row, part = row[keep], part[keep]
            if met.dtype == object:
                np.add.at(met, row, part)
            else:
                met += np.bincount(row, part, n)
        at = np.flatnonzero(alive)
        known = met[at] // unit
        if depth == 1.0 or not len(at):
            return at, known
        begun, fresh = live[read[live] > 0], live[read[live] == 0]
        unmet = len(begun) - (met[at] - known * unit)
        upper = known + unmet * level + ends[fresh].sum()
        lower = known + unmet * (lasts[begun].min() if len(begun) else 0) + lasts[fresh].sum()
        if len(at) >= k:
            kth = np.partition(lower, len(at) - k)[len(at) - k]
            floor = kth if floor is None else max(floor, kth)
        if floor is not None and floor > LEAST:  # scores beyond the ends are ties
            alive[at[upper < min(floor, LARGEST)]] = False
            few = alive.sum() <= n // 4


def search(spark: SparkSession, df: DataFrame, modulus: int = 100, k: int = 10, factor: int = 1024, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best other rows by inner product, ties to the smaller id.

    Queries are the rows whose integer id is divisible by ``modulus``; every other row is a candidate, rows
    with the query's id or vector included.  Repeated ids are rows, and queries, of their own.  A row without
    an id is a candidate that comes after equal scores.  Vectors that are null or hold null, NaN or infinite
    components take no part; a query meets only vectors of its own length.  A score beyond 64
    bits counts as the nearest that fits.  No table column but the two is read; an empty table gives an empty result.
    """
    lists = blocks(spark, whole_vectors(df, vec_id, vector, factor))
    asked = queries_of(spark, lists, modulus)
    id_type = lists.schema["ids"].dataType.elementType.simpleString()
    counted, held = asked.count(), lists.count()
    packs = max(1, -(-counted // max(LEAST_PACK, min(MOST_PACK, -(-counted // PACKS)))))
    units = max(1, -(-held // UNIT_BLOCKS))

    def dealt(rows: DataFrame, row: str, own: str, number: int, other: str, others: int) -> DataFrame:
        """The rows of each pack (or unit), once for every unit (or pack)."""
        rows = rows.withColumn(own, F.pmod(F.xxhash64(row), F.lit(number)).cast("int"))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        return rows.repartition(max(1, min(20_000, 2 * packs * units)), "unit", "pack")

    there = dealt(asked, "row", "pack", packs, "unit", units).groupBy("unit", "pack")
    here = dealt(lists, "block", "unit", units, "pack", packs).groupBy("unit", "pack")

    def meet(asked: pa.Table, lists: pa.Table) -> pa.Table:
        found = {"query": [], "query_id": [], "vec_id": [], "score": []}
        held: dict[int, list] = {}
        for b in lists.to_pylist() if asked.num_rows else []:
            shape = b["dim"], len(b["ids"])
            places = np.frombuffer(b["places"], np.uint16).astype(np.intp).reshape(shape)
            terms, levels = (np.frombuffer(b[c], b["kind"]) for c in ("terms", "levels"))
            held.setdefault(b["dim"], []).append((b["block"], b["ids"], places, terms.reshape(shape), levels.reshape(b["dim"], MARKS)))
        for blocks in held.values():
            for i, (block, ids, places, terms, levels) in enumerate(blocks):
                top = np.abs(levels[:, [0, -1]].astype(object)).max(1)  # each list's largest size
                kind = float if terms.dtype != np.int64 else object
                blocks[i] = block, ids, places, terms.astype(kind), levels.astype(kind), top
        for q in asked.to_pylist():
            best: list = []
            vector = np.frombuffer(q["vector"], q["kind"]).astype(object)
            for block, ids, places, terms, levels, top in held.get(q["dim"], []):
                wide = terms.dtype == object or (abs(vector) * top).sum() * one_term(q["dim"]) >= EXACT
                if wide:
                    terms, levels = whole(terms), whole(levels)
                query = vector if wide else vector.astype(float)
                own = q["row"] & 0xFFFF if q["row"] >> 16 == block else -1
                at, scores = best_in_block(query, places, terms, levels, k, -best[k - 1][0] if len(best) >= k else None, own)
                scores = np.clip(scores, LEAST, LARGEST) if wide else scores
                if len(at) > k:  # the k-th best score's ties stay, so that ids can decide
                    least = np.partition(scores, len(at) - k)[len(at) - k]
                    at, scores = at[scores >= least], scores[scores >= least]
                best = sorted(best + [(-int(s), ids[i] is None, ids[i] or 0) for i, s in zip(at, scores)])[:k]
            for s, without, i in best:
                found["query"].append(q["row"])
                found["query_id"].append(q["query_id"])
                found["vec_id"].append(None if without else i)
                found["score"].append(-s)
        ids = asked.schema.field("query_id").type
        return pa.table([pa.array(found["query"], pa.int64()), pa.array(found["query_id"], ids), pa.array(found["vec_id"], ids),
                         pa.array(found["score"], pa.int64())], names=list(found))

    met = there.cogroup(here).applyInArrow(meet, BEST_SCHEMA.format(id=id_type))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return met.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
