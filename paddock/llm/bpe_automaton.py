"""Op 1: BPE encoding and decoding with a compiled tokenization automaton.

A token sequence is the BPE encoding of its text exactly when every neighbouring pair
of tokens can stand side by side after all merges.  That set of sequences is regular:
its automaton has one state per token (the state after reading it), and is built by
adding one gadget per merge, in order of rank.  The gadget of ``u v -> w`` at rank r

* takes the arc ``v`` away from the state after ``u`` (from rank r on the two merge);
* adds the arc ``w`` wherever ``u`` could be read at that time (prefix link, rank r);
* lets ``w`` lead to the state after ``v`` as it is at that time (suffix link, rank r).

The links keep the older rows of the states, so a state is never copied, and the whole
compilation is linear in the number of merges.  An arc of the finished automaton is
looked up along the links once and then kept in a table.

Encoding walks a pre-split word from left to right by the tables: from a state it takes
the arc with the longest label that fits, and goes back where no arc leads on.
Decoding emits the labels of the arcs (here, like the tokenizer without a decoder, the
vocabulary strings with a blank between them).
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from . import common

NEVER = 1 << 60
#: Lengths of labels that are tried whatever follows.
SHORT = (3, 2, 1)
#: Entries of each generation of a per-process memo.
MEMO = 300_000
#: White space for ``str.split`` but not for the tokenizer's pattern.
NOT_SPACE = re.compile("[\x1c-\x1f]")
BLANK = regex.compile(r"\s+")


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """The compiled automaton of a list of merges.

    Every token must have one merge, and a merge may use only tokens of earlier merges;
    then merging rule by rule and merging the best pair first agree.  Otherwise ValueError.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.label = {i: s for s, i in vocab.items()}
        self.blocked: dict[int, dict[int, int]] = {}
        self.prefix: dict[int, tuple[int, int]] = {}
        self.suffix: dict[int, tuple[int, int]] = {}
        self._arc: dict[int, bool] = {}
        self._heads: dict[int, list[tuple[int, int]]] = {}
        letters = byte_letters()
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        made = {s for s in vocab if len(s.removesuffix(suffix)) == 1}
        for rank, (u, v) in enumerate(merges):
            w = u + v
            if u not in made or v not in made or w in made:
                raise ValueError(f"merge {rank} ({u} {v}) does not follow from earlier ones")
            made.add(w)
            self._gadget(vocab[u], vocab[v], vocab[w], rank)
        for s in made:
            word = s.removesuffix(suffix) if s.endswith(suffix) else s
            into = self.final if s.endswith(suffix) else self.inner
            into[bytes(letters[c] for c in word)] = vocab[s]
        self.longest = max(map(len, self.final), default=0)
        # by its first four bytes, the lengths that an inner label can have, longest first
        found: dict[bytes, set[int]] = {}
        for label in self.inner:
            if len(label) >= 4:
                found.setdefault(label[:4], set()).add(len(label))
        self._lengths = {head: (*sorted(sizes, reverse=True), *SHORT) for head, sizes in found.items()}

    def _gadget(self, u: int, v: int, w: int, rank: int) -> None:
        self.blocked.setdefault(u, {})[v] = rank
        self.prefix[w] = (u, rank)
        self.suffix[w] = (v, rank)

    def arc(self, after: int, token: int) -> bool:
        """Whether the state after one token has an arc for the next one."""
        key = after << 32 | token
        if (known := self._arc.get(key)) is None:
            if len(self._arc) >= 2 * MEMO:
                self._arc.clear()
            known = self._arc[key] = self._follow(after, token)
        return known

    def _follow(self, after: int, token: int) -> bool:
        heads = self._heads.get(token)
        if heads is None:
            heads, right, before = [], token, NEVER
            while True:
                heads.append((right, before))
                if right not in self.prefix:
                    break
                right, before = self.prefix[right]
            self._heads[token] = heads
        left, until = after, NEVER
        while True:
            if rules := self.blocked.get(left):
                for right, before in heads:
                    # the rule takes effect while both parts still stand alone
                    if right in rules and (rank := rules[right]) < until and rank <= before:
                        return False
            if left not in self.suffix:
                return True
            left, until = self.suffix[left]

    def encode(self, word: bytes) -> list[int]:
        """Tokens of one pre-split word (not empty): the last one carries the word end.

        A prefix of the word has one accepted token sequence, so a place from which no arc
        leads to the end is given up for good: every place is left at most once.
        """
        inner, final, lengths, arcs = self.inner, self.final, self._lengths, self._arc
        n, at, after, top = len(word), 0, -1, NEVER
        dead: set[int] = set()
        out: list[int] = []
        stack: list[tuple[int, int, int]] = []
        while at < n:
            rest = n - at
            token = final.get(word[at:]) if rest < top and rest <= self.longest else None
            if token is not None and (after < 0 or self.arc(after, token)):
                out.append(token)
                return out
            for size in lengths.get(word[at : at + 4], SHORT):
                if size < rest and size < top and (token := inner.get(word[at : at + size])) is not None and at + size not in dead:
                    known = after < 0 or arcs.get(after << 32 | token)
                    if known or (known is None and self.arc(after, token)):
                        stack.append((at, after, size))
                        out.append(token)
                        at, after, top = at + size, token, NEVER
                        break
            else:
                dead.add(at)
                at, after, top = stack.pop()
                out.pop()
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.label[i] for i in ids)


class Memo(dict):
    """Results by text; a full memo becomes the old generation, and the oldest goes."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, text: str):
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        found = self.old.get(text)
        if found is None:
            found = self.make(text)
        if len(text) < 100:
            self[text] = found
        return found


class Tokenizer:
    """Pre-splitting, memo and automaton of one tokenizer file (NFC, lower case, byte-level word BPE)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        splitter = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = regex.compile(splitter["pattern"]["Regex"])
        self.split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(splitter["pattern"]["Regex"]), splitter["behavior"].lower(), splitter["invert"])
        self.normalizer = tokenizers.Tokenizer.from_file(path).normalizer
        self.plain = self._plain()
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        self.label = {i: s for s, i in (spec["model"]["vocab"] | self.added).items()}
        self.word = self.word_encoder(path, spec["model"])
        self.words = Memo(self.word)
        self.ids = Memo(self._ids)
        self.labels = Memo(lambda run: self.decode(self.ids[run]))

    def _plain(self) -> re.Pattern:
        """ASCII, and letters of alphabets with cases that Python and the library treat alike, one by one."""
        alike = []
        for c in map(chr, range(0xC0, 0x530)):
            if c.isalpha() and len(c.lower()) == 1 and c != "Σ":  # Python looks at what follows a sigma
                if self.normalizer.normalize_str(c) == c.lower() and len(self.split.pre_tokenize_str(f"a{c}b")) == 1:
                    alike.append(c)
        return re.compile(rf"[\x00-\x7f{''.join(alike)}]+")

    def word_encoder(self, path: str, model: dict) -> Callable[[str], bytes]:
        """The function that gives the ids of a pre-split word, as little-endian 32-bit integers."""
        automaton = Automaton(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])

        def encode(word: str) -> bytes:
            ids = automaton.encode(word.encode())
            return struct.pack(f"<{len(ids)}I", *ids)

        return encode

    def _ids(self, run: str) -> bytes:
        """Ids of a run without white space, or of a special token, as little-endian 32-bit integers."""
        if run in self.added:
            return struct.pack("<I", self.added[run])
        if not self.plain.fullmatch(run):  # which characters are letters, and what they compose to, is as the library has it
            pieces = self.split.pre_tokenize_str(self.normalizer.normalize_str(run))
            return b"".join([self.words[piece] for piece, _ in pieces])
        text = run.lower()
        if text == run and text.isalpha():
            return self.word(run)
        pieces = [text] if text.isalpha() else self.pattern.findall(text)
        if pieces == [run]:
            return self.word(run)
        return b"".join([self.ids[piece] for piece in pieces])  # each is a run that is cut no further

    def runs(self, text: str) -> list[str]:
        """A text's runs without white space; the special tokens in it are runs of their own."""
        if "<|" in text or NOT_SPACE.search(text):
            pieces = self.marks.split(text)
            return [run for piece in pieces for run in BLANK.split(piece) if run]
        return text.split()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        return b"".join(map(self.ids.__getitem__, self.runs(text)))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.label.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))

    def round_trip(self, text: str) -> tuple[bytes, str]:
        """(ids, the text that they decode to)."""
        runs = self.runs(text)
        return b"".join(map(self.ids.__getitem__, runs)), " ".join(map(self.labels.__getitem__, runs))


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The compiled tokenizer of this process; compiled once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def bpe_round_trip(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text; one row per input row, nothing is shuffled.

    Columns: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.  A null text counts as
    empty (no ids); repeated rows give repeated results; an empty table gives an empty result.
    Memory of a worker: the compiled tables, the memos and a few texts.
    """
    rows = common.pick(df, doc_id=doc_id, text=text)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for batch in batches:
            for part in common.slices(batch):
                n, ids_sum, text_sum = [], [], []
                for value in common.texts(part):
                    ids, decoded = tok.round_trip(value)
                    n.append(len(ids) // 4)
                    ids_sum.append(hashlib.sha256(ids).hexdigest())
                    text_sum.append(hashlib.sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sum, pa.string()), pa.array(text_sum, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return rows.mapInArrow(run, schema)


def bpe_tokens(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` text of every row: the operator's plain output."""
    rows = common.pick(df, doc_id=doc_id, text=text)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tok = tokenizer(path)
        for batch in batches:
            for part in common.slices(batch):
                got = [tok.round_trip(value) for value in common.texts(part)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([np.frombuffer(ids, "<u4").astype(np.int32) for ids, _ in got], pa.list_(pa.int32())),
                        pa.array([decoded for _, decoded in got], pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    return rows.mapInArrow(run, schema)
