"""Hashed word shingles of texts, as sets of 64-bit numbers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

#: Words whose hashes a task remembers; the memory is emptied when full.
REMEMBERED = 300_000
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingler(k: int) -> Callable[[str], np.ndarray]:
    """``text -> sorted distinct hashes`` of its runs of ``k`` words.

    A-Z count as a-z; words are what ASCII white space separates. A text of fewer words is
    one shingle, a text without words has none.
    """
    factors = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    known: dict[bytes, int] = {}

    def look_up(word: bytes) -> int:
        found = known.get(word)
        if found is None:
            found = xxhash.xxh3_64_intdigest(word)
            if len(word) <= 40:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[word] = found
        return found

    def shingles(text: str) -> np.ndarray:
        words = text.encode("utf-8").lower().split()
        n = len(words)
        if not n:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(look_up, words), np.uint64, n)
        size = min(k, n)
        out = np.full(n - size + 1, size, np.uint64)
        for i in range(size):
            out += hashes[i: n - size + 1 + i] * factors[i]
        return np.unique(mix(out))

    return shingles
