"""Hashed byte trigrams of texts, counted with array operations."""

from __future__ import annotations

import numpy as np

from .words import LOWER

#: ASCII bytes that are no letters become a blank.
LETTERS_ONLY = LOWER.copy()
LETTERS_ONLY[:128][~np.array([chr(b).isalpha() for b in range(128)])] = 32
#: Bytes of a text handled at once.
PIECE = 1 << 20
_FACTOR = np.uint32(0x9E3779B1)


def counts(text: str, bits: int, letters_only: bool) -> np.ndarray:
    """How often each of 2**bits hashed trigrams occurs in the whole lower-cased text."""
    data = np.frombuffer(f" {text} ".encode(), np.uint8)
    total = np.zeros(1 << bits, np.int64)
    for lo in range(0, max(1, len(data) - 2), PIECE):
        low = (LETTERS_ONLY if letters_only else LOWER)[data[lo : lo + PIECE + 2]]
        if letters_only and len(low) > 1:  # one blank for a run of them
            low = low[np.concatenate(([True], (low[1:] != 32) | (low[:-1] != 32)))]
        if len(low) < 3:
            continue
        code = low.astype(np.uint32)
        code = code[:-2] << np.uint32(16) | code[1:-1] << np.uint32(8) | code[2:]
        total += np.bincount((code * _FACTOR) >> np.uint32(32 - bits), minlength=len(total))
    return total
