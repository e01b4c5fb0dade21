"""Word shingles of whole documents as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from outagegrid.llm.common import words

MEMO_WORDS = 500_000  # a task forgets its word hashes beyond this; results do not depend on it
STEP = np.uint64(0x9E3779B97F4A7C15)
FINISH = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * FINISH
    return x ^ (x >> np.uint64(29))


def shingle_hashes(data: bytes, memo: WordHashes, width: int) -> np.ndarray:
    """Sorted distinct hashes of all ``width``-word shingles; a shorter text is one shingle of all its words, a text
    without words has none."""
    if len(memo) > MEMO_WORDS:
        memo.clear()
    hashed = np.array([memo[w] for w in words(data)], dtype=np.uint64)
    if not len(hashed):
        return hashed
    take = min(width, len(hashed))
    n = len(hashed) - take + 1
    total = np.full(n, take, dtype=np.uint64)
    for k in range(take):
        total = mixed(total * STEP + hashed[k : k + n])
    return np.unique(total)
