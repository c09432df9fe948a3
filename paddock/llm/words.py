"""Whole columns of text to word hashes, with array operations over the bytes.

A word's hash is a polynomial over its bytes modulo 2**64, mixed.  Two rules cut
words: at ASCII white space (``SPACES``), or at every ASCII byte that is no letter
or digit (``LETTERS``).  Letters A-Z are lower-cased first; ``LETTERS`` also lower-cases
the Latin-1 capitals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
#: Bytes handled at once: a few array copies of eight times this are held.
BYTES_AT_ONCE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LETTERS = np.ones(256, bool)
LETTERS[128:] = False
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, U)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        factor = U((int(out[done - 1]) * int(BASE)) % (1 << 64))
        out[done : done + step] = out[:step] * factor
        done += step
    return out


_POWERS = _powers(1 << 12)


def _hash_bytes(data: np.ndarray, cut: np.ndarray, prefix: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, hash) of each word of the bytes; ``cut`` says which bytes separate.

    ``prefix``: only so many bytes of a word count (0: all).
    """
    global _POWERS
    edge = np.flatnonzero(np.diff(np.concatenate(([True], cut, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, start, np.empty(0, U)
    # byte k of a word is multiplied by BASE**k
    size = end - start
    if size.max() > len(_POWERS):
        _POWERS = _powers(int(size.max()))
    inside = ~cut
    offset = np.flatnonzero(inside) - np.repeat(start, size)
    body = (data[inside].astype(U) + U(1)) * _POWERS[offset]
    if prefix:
        body[offset >= prefix] = 0
        size = np.minimum(size, prefix)
        first = np.concatenate(([0], np.cumsum(end - start)[:-1]))
        return start, size, mix(np.add.reduceat(body, first) + size.astype(U) * BASE)
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    return start, size, mix(np.add.reduceat(body, first) + size.astype(U) * BASE)


def _lower(data: np.ndarray, rule: np.ndarray) -> np.ndarray:
    data = LOWER[data]
    if rule is LETTERS and len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[1:][capital] += 32
    return data


def documents(column: pa.Array, rule: np.ndarray, prefix: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its words in order) for every row; null is a text without words.

    With ``prefix``, words that share their first so many bytes share a hash.
    """
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if not n:
        return
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + BYTES_AT_ONCE, "right")) - 1)
        hi = min(hi, n)
        yield from _some(data, ends, lo, hi, rule, prefix)
        lo = hi


def _some(data: np.ndarray, ends: np.ndarray, lo: int, hi: int, rule: np.ndarray, prefix: int) -> Iterator[tuple[int, np.ndarray]]:
    first, last = int(ends[lo]), int(ends[hi])
    if hi == lo + 1 and last - first > 4 * BYTES_AT_ONCE:
        yield lo, _long(data[first:last], rule, prefix)
        return
    # one separator between documents, so that no word spans two of them
    sizes = np.diff(ends[lo : hi + 1])
    body = np.zeros(last - first + hi - lo, np.uint8)
    keep = np.ones(len(body), bool)
    keep[np.cumsum(sizes + 1) - 1] = False
    body[keep] = _lower(data[first:last], rule)
    cut = rule[body]
    cut[~keep] = True
    start, _, hashes = _hash_bytes(body, cut, prefix)
    bounds = np.searchsorted(start, np.concatenate(([0], np.cumsum(sizes + 1))))
    for k in range(hi - lo):
        yield lo + k, hashes[bounds[k] : bounds[k + 1]]


def _long(data: np.ndarray, rule: np.ndarray, prefix: int) -> np.ndarray:
    """The words of one very long text, piece by piece; pieces end at separators."""
    out, at = [], 0
    while at < len(data):
        to = min(len(data), at + BYTES_AT_ONCE)
        while to < len(data):
            cuts = np.flatnonzero(rule[data[at:to]])
            if len(cuts):
                to = at + int(cuts[-1]) + 1
                break
            to = min(len(data), to + BYTES_AT_ONCE)
        low = _lower(data[at:to], rule)
        out.append(_hash_bytes(low, rule[low], prefix)[2])
        at = to
    return np.concatenate(out) if out else np.empty(0, U)


def word_hash(word: bytes) -> int:
    """The hash of one lower-cased word."""
    data = np.frombuffer(word, np.uint8)
    return int(_hash_bytes(data, np.zeros(len(data), bool))[2][0])


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word runs; fewer words make one run; no words, none."""
    if not len(words):
        return words
    k = min(k, len(words))
    total = np.full(len(words) - k + 1, U(k), U)
    for j in range(k):
        total = mix(total * BASE + words[j : len(words) - k + 1 + j])
    return np.unique(total)


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word runs in order (none when there are fewer words)."""
    if len(words) < k:
        return np.empty(0, U)
    total = np.full(len(words) - k + 1, U(k), U)
    for j in range(k):
        total = mix(total * BASE + words[j : len(words) - k + 1 + j])
    return total
