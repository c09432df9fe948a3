"""Op 5: token ids in compressed files with a shared zstandard dictionary.

Every document's ids (end id included) are serialised as little-endian integers of 2 or 4
bytes and compressed by themselves, all with one dictionary that is trained on a bounded
sample of serialised documents.  Documents are written in ascending doc_id order as rows of blocks:
the dictionary's hash, the documents' ids and token counts, the offsets of their bodies, and the
bodies.  A short document is read from one block, by its offset, without the rest.

Spark's Parquet writer and reader carry the blocks, so any store that Spark reaches will do.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .bpe_automaton import Tokenizer, byte_letters

END_ID = 1
#: The dictionary: its size, and the sample it is trained on (documents at most, and bytes of each, from a hashed place).
DICTIONARY_BYTES = 64 << 10
SAMPLE, SAMPLE_BYTES = 2000, 8 << 10
LEVEL = 3
#: A block ends with the document that brings it to so many bytes, or so many documents.
BLOCK_BYTES, BLOCK_DOCUMENTS = 1 << 20, 4096

BLOCK = "part int, block int, dictionary string, width int, first_id bigint, last_id bigint, doc_ids array<bigint>, n_tokens array<bigint>, offsets array<bigint>, body binary"


class LibraryTokenizer(Tokenizer):
    """The tokenizers library's model, asked once for each word that the memos do not hold."""

    def word_encoder(self, path: str, model: dict) -> Callable[[str], bytes]:
        tokenize = tokenizers.Tokenizer.from_file(path).model.tokenize
        letters = {byte: letter for letter, byte in byte_letters().items()}

        def encode(word: str) -> bytes:
            if not (word.isascii() and word.isprintable()):
                word = word.encode().decode("latin-1").translate(letters)
            ids = [token.id for token in tokenize(word)]
            return struct.pack(f"<{len(ids)}I", *ids)

        return encode


_LOADED: dict[str, LibraryTokenizer] = {}


def tokenizer(path: str) -> LibraryTokenizer:
    """The tokenizer of this process, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = LibraryTokenizer(path)
    return _LOADED[path]


def width_of(path: str) -> int:
    """Bytes of an id."""
    return 2 if max(tokenizer(path).label) < 1 << 16 else 4


def serialised(path: str, text: str, width: int) -> bytes:
    ids = np.frombuffer(tokenizer(path).encode(text), "<u4")
    return np.append(ids, np.uint32(END_ID)).astype(f"<u{width}").tobytes()


def piece(ids: bytes, width: int) -> bytes:
    """SAMPLE_BYTES of a serialised document, from a place that its hash gives."""
    places = max(0, len(ids) - SAMPLE_BYTES) // width + 1
    at = zlib.crc32(ids) % places * width
    return ids[at : at + SAMPLE_BYTES]


def train(samples: list[bytes]) -> bytes:
    """The dictionary's bytes; too few samples give their joined bytes as plain content, none an empty one."""
    joined = b"".join(samples)
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, len(joined) // 10)), samples).as_bytes()
    except zstandard.ZstdError:
        return joined[-DICTIONARY_BYTES:]


def _dictionary(body: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(body) if len(body) >= 8 else None


def write(spark: SparkSession, df: DataFrame, path: str, tokens: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the documents' ids below ``path``: ``blocks`` and ``dictionary``, both Parquet."""
    rows = common.pick(df, doc_id=doc_id, text=text)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    width = width_of(tokens)
    share = F.lit(min(1.0, SAMPLE / max(1, rows.count())))
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                yield pa.RecordBatch.from_arrays([pa.array([piece(serialised(tokens, t, width), width) for t in common.texts(part)], pa.binary())], ["body"])

    sample = common.drawn(rows, ["doc_id", "text"], share).orderBy("draw").limit(SAMPLE).select("text").mapInArrow(sampled, "body binary").collect()
    dictionary = train(sorted(bytes(r["body"]) for r in sample))
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, bytearray(dictionary))], "dictionary string, body binary").coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(LEVEL, dict_data=_dictionary(shared.value), write_dict_id=False)
        for batch in batches:
            for part in common.slices(batch):
                ids = [serialised(tokens, t, width) for t in common.texts(part)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(i) // width for i in ids], pa.int64()), pa.array([press.compress(i) for i in ids], pa.binary())],
                    ["doc_id", "n", "body"],
                )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list = []
        counts: list[int] = []
        bodies: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            offsets = np.concatenate(([0], np.cumsum([len(b) for b in bodies]))).tolist()
            known = [i for i in ids if i is not None]
            values = [part, number, name, width, min(known, default=None), max(known, default=None), ids, counts, offsets, b"".join(bodies)]
            long, many = pa.int64(), pa.list_(pa.int64())
            types = [pa.int32(), pa.int32(), pa.string(), pa.int32(), long, long, many, many, many, pa.binary()]
            names = [f.split()[0] for f in BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for batch in batches:
            for row in batch.to_pylist():
                ids.append(row["doc_id"])
                counts.append(row["n"])
                bodies.append(row["body"])
                size += len(row["body"])
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCUMENTS:
                    yield block()
                    ids, counts, bodies, size, number = [], [], [], 0, number + 1
        if ids:
            yield block()

    # written once: the range partitioning reads its input twice
    out = common.stage(spark, rows.mapInArrow(packed, "doc_id bigint, n bigint, body binary"), "packed")
    out = out.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "body")
    out.mapInArrow(blocks, BLOCK).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _bodies(spark: SparkSession, path: str, want: set[int] | None = None):
    """A function for mapInArrow: (part, block, doc_id, n, start in the block, ids) of the blocks' documents."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["body"])
    if hashlib.sha256(dictionary).hexdigest() != row["dictionary"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    shared = spark.sparkContext.broadcast((row["dictionary"], dictionary))

    def documents(batch: pa.RecordBatch) -> Iterator[tuple]:
        name, body = shared.value
        press = zstandard.ZstdDecompressor(dict_data=_dictionary(body))
        for i in range(batch.num_rows):
            # the body column is not turned into Python objects as a whole: documents are cut out of it
            block = {c: batch.column(c)[i].as_py() for c in ("part", "block", "dictionary", "width", "doc_ids", "n_tokens", "offsets")}
            if block["dictionary"] != name:
                raise ValueError(f"a block was written with dictionary {block['dictionary']}")
            view, start = memoryview(batch.column("body")[i].as_buffer()), 0
            for doc_id, n, lo, hi in zip(block["doc_ids"], block["n_tokens"], block["offsets"], block["offsets"][1:]):
                if want is None or doc_id in want:
                    ids = np.frombuffer(press.decompress(view[lo:hi], max_output_size=n * block["width"]), f"<u{block['width']}")
                    yield block["part"], block["block"], doc_id, n, start, ids
                start += n

    return documents


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    documents = _bodies(spark, path)
    files = spark.read.parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(p, b, d, n, s, zlib.crc32(ids.astype("<u4").tobytes())) for p, b, d, n, s, ids in documents(batch)]
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4]
            names = ["part", "block", "doc_id", "n_tokens", "inner", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], t) for k, t in enumerate(kinds)], names)

    rows = files.mapInArrow(run, "part int, block int, doc_id bigint, n_tokens bigint, inner bigint, ids_crc32 bigint")
    sizes = files.select("part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    # one row per file for the sums over files, then one per block within each file
    each = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = each.selectExpr("part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as before")
    within = sizes.selectExpr("part", "block", "coalesce(sum(n) over (partition by part order by block rows between unbounded preceding and 1 preceding), 0) as within")
    starts = within.join(before, "part").select("part", "block", (F.col("before") + F.col("within")).alias("begin"))
    return rows.join(starts, ["part", "block"]).select("doc_id", (F.col("begin") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of some documents: only blocks whose range holds one are read, only they are decompressed."""
    want = set(doc_ids)
    documents = _bodies(spark, path, want)
    files = spark.read.parquet(f"{path}/blocks")
    ranges = [(F.col("first_id") <= i) & (F.col("last_id") >= i) for i in sorted(want)]
    near = F.lit(False)
    for r in ranges:
        near = near | r

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = list(documents(batch))
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[2] for g in got], pa.int64()), pa.array([g[5].astype(np.int64) for g in got], pa.list_(pa.int64()))], ["doc_id", "ids"]
            )

    return files.where(near).mapInArrow(run, "doc_id bigint, ids array<bigint>")


def token_files(spark: SparkSession, df: DataFrame, path: str, tokens: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents and read them back: ``doc_id, start, n_tokens, ids_crc32``.

    A null text counts as empty and has the end id alone.  Null ids come first; repeated ids follow each
    other in the order of their bodies.  An empty table writes no block and gives an empty result.
    """
    write(spark, df, path, tokens, doc_id, text)
    return read(spark, path)
