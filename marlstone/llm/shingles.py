"""Word shingles of texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

WORDS_EACH = 5
#: Odd numbers.
MULTIPLIERS = [np.uint64((2 * i + 1) * 0x9E3779B97F4A7C15 % 2**64) for i in range(WORDS_EACH)]
#: Words whose hashes a task remembers.
REMEMBER = 200_000


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the others (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingler() -> Callable[[str], np.ndarray]:
    """A function from a text to the sorted hashes of its different shingles: runs of five words, lower-cased in A-Z;
    the whole sequence where there are fewer; none without words."""
    known = _Words()

    def shingles(text: str) -> np.ndarray:
        words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
        if not words:
            return np.zeros(0, dtype=np.uint64)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        n = len(h)
        if n < WORDS_EACH:
            h = np.concatenate([h, np.full(WORDS_EACH - n, n, dtype=np.uint64)])
        m = len(h) - WORDS_EACH + 1
        total = h[:m] * MULTIPLIERS[0]
        for i in range(1, WORDS_EACH):
            total += mixed(h[i : i + m]) * MULTIPLIERS[i]
        return np.unique(mixed(total))

    return shingles


def node_of(shingles: np.ndarray) -> int:
    """A signed 64-bit digest of the set: equal sets have equal ones."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)
