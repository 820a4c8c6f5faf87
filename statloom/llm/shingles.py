"""Hashed word shingles of a text."""

from __future__ import annotations

import numpy as np
import xxhash

FOLD, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hash of a word; words seen lately are kept, at most about `limit`."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `words` words; A-Z count as a-z, white space is that of ASCII.

    A text with fewer words gives the whole sequence as one shingle; one without words gives none. Two different shingles
    get one hash with a chance of 2**-64.
    """
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    codes = np.array([hashes[w] for w in found], dtype=np.uint64)
    k = min(words, len(codes))
    value = np.full(len(codes) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        value = (value ^ (value >> np.uint64(31))) * FOLD + codes[i : len(codes) - k + 1 + i]
    value = (value ^ (value >> np.uint64(29))) * MIX
    return np.unique(value ^ (value >> np.uint64(32)))
