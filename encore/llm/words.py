"""Words of a text and their hashes, for the operators that run in Python tasks.

A word is a run of characters other than space, tab, line feed, vertical tab,
form feed and carriage return.  In UTF-8 that is exactly what ``bytes.split()``
returns, so texts are handled as bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multiplier of the rolling window hash (arithmetic modulo 2**64).
BASE = 0x9E3779B97F4A7C15
#: Entries after which a task's word table starts anew, to bound its memory.
TABLE_ENTRIES = 100_000


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, computed once per distinct word while the table lasts."""

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_ENTRIES:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """BASE**i (``up``) or its inverse (``down``) for i < n, modulo 2**64."""
    have = _powers[kind]
    if len(have) < n:
        size = max(n, 2 * len(have))
        factor = BASE if kind == "up" else pow(BASE, -1, 1 << 64)
        have = np.full(size, factor, np.uint64)
        have[0] = 1
        have = _powers[kind] = np.multiply.accumulate(have)
    return have[:n]


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` consecutive words (empty if there are fewer)."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _power("up", n), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * _power("down", n - width + 1))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all 64 bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed LONG."""
    return x.view(np.int64)
