"""Op 7: exact dedup by deterministic block naming, in DataFrame operations alone.

A text without its white space is cut into blocks of a fixed number of bytes.  All distinct
blocks of the corpus are sorted and numbered, so equal blocks, and no others, share an integer
name.  Then neighbouring names of a document are paired, the distinct pairs are sorted and
numbered in turn, and so on until each document has one name.  Documents are equal exactly
when they reach the same name on the same level.

Blocks are shuffled and sorted by two 64-bit hashes of their bytes; the step that collects the
distinct blocks compares the bytes as well, and where two blocks share both hashes the
naming starts again with other seeds.  A name is therefore never given to two blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common

#: Bytes of a block.  Only the number of rounds depends on it, not the result.
BLOCK_BYTES = 4096


def _normalised(rows: DataFrame) -> DataFrame:
    """rid, points, body: the text without white space as bytes."""
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "rid", F.char_length(text).alias("points"),
        F.regexp_replace(text, r"[\x20\x09-\x0D]+", "").cast("binary").alias("body"),
    )


def _hashes(block, seed: int) -> list:
    return [F.xxhash64(F.lit(seed + k), block) for k in (0, 1)]


def _numbered(spark: SparkSession, distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys in sorted order with an integer name each (from 1; gaps between partitions)."""
    ordered = distinct.orderBy(*keys).withColumn("name", F.monotonically_increasing_id() + 1)
    return common.stage(spark, ordered, "names")


def identities(spark: SparkSession, rows: DataFrame, block: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """For rows (rid unique, text): the staged rows (rid, points, size, text_sha256) and (rid, level, name).

    Texts without a character other than white space have no block: they are in the first frame alone.
    """
    whole = _normalised(rows).withColumn("size", F.octet_length("body"))
    blocks_of = F.ceil(F.col("size") / block).cast("int")
    places = whole.where("size > 0").select("rid", "body", F.explode(F.sequence(F.lit(0), blocks_of - 1)).alias("i"))
    cut = F.substring("body", F.col("i") * block + 1, F.lit(block))

    seed = 1
    while True:
        h1, h2 = _hashes(F.col("content"), seed)
        contents = places.select(cut.alias("content")).select(h1.alias("h1"), h2.alias("h2"), "content").distinct()
        per_hash = contents.groupBy("h1", "h2").agg(F.count("*").alias("contents"))
        names = _numbered(spark, per_hash, ["h1", "h2"])
        if not names.where("contents > 1").take(1):
            break
        seed += 2  # two blocks share both hashes: name again under other ones

    base = common.stage(spark, whole.select("rid", "points", "size", F.sha2("body", 256).alias("text_sha256")), "texts")
    h1, h2 = _hashes(cut, seed)
    left = places.select("rid", "i", h1.alias("h1"), h2.alias("h2"))
    left = left.join(names.select("h1", "h2", "name"), ["h1", "h2"]).select("rid", "i", "name")
    counts = base.where("size > 0").select("rid", blocks_of.alias("n"))
    named = common.stage(spark, left.join(counts, "rid"), "named-0")
    done = named.where("n = 1").select("rid", F.lit(0).alias("level"), "name")
    level = 0
    while True:
        rest = named.where("n > 1")
        if not rest.take(1):
            return base, done
        level += 1
        pairs = rest.groupBy("rid", F.expr("i div 2").alias("i"), F.expr("(n + 1) div 2").alias("n")).agg(
            F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(0)).alias("b"),
        )
        pairs = common.stage(spark, pairs, f"pairs-{level}")
        names = _numbered(spark, pairs.select("a", "b").distinct(), ["a", "b"])
        named = common.stage(spark, pairs.join(names, ["a", "b"]).select("rid", "i", "n", "name"), f"named-{level}")
        done = done.unionByName(named.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))


def decisions(spark: SparkSession, rows: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """For rows (rid unique, doc_id, text): rid, doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest doc_id (a null id
    comes last), then the smallest rid: exactly one row of each group.
    """
    base, done = identities(spark, rows.select("rid", "text"), block)
    ids = rows.select("rid", "doc_id")
    # nothing but white space: one group of its own, on a level no other text has
    level, name = F.coalesce("level", F.lit(-1)).alias("level"), F.coalesce("name", F.lit(0)).alias("name")
    each = base.join(done, "rid", "left").join(ids, "rid")
    each = common.stage(spark, each.select("rid", "doc_id", "points", "text_sha256", level, name), "each")
    rank = F.struct((-F.col("points")).alias("fewer"), F.col("doc_id").isNull().alias("unknown"), "doc_id", "rid")
    best = each.groupBy("level", "name").agg(F.min(rank).alias("best"), F.count("*").alias("group_size"))
    best = best.select("level", "name", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"), "group_size")
    return each.join(best, ["level", "name"]).select(
        "rid", "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256"
    )


def exact_dedup(spark: SparkSession, df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null counts as empty; texts of white space alone are equal to it.  Repeated rows are members
    of their group like others and one of them stays.  Ids of any type that has an order; other columns are ignored.
    An empty table gives an empty result.
    """
    rows = common.row_ids(spark, common.pick(df, doc_id=doc_id, text=text))
    return decisions(spark, rows).drop("rid")


def drop_copies(spark: SparkSession, df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    kept, restore = common.tracked(spark, df, doc_id, text)
    decided = decisions(spark, kept.select("rid", "doc_id", "text"))
    return restore(kept.join(decided.where("not kept").select("rid"), "rid", "left_anti"))
