"""Vectorised 64-bit hashing of words and of runs of words inside Python tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_CACHED_WORDS = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash per word; words seen before are looked up. Cleared when full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = values + np.uint64(seed * int(_STEP) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``size`` consecutive words.

    Hashes of neighbouring runs are built from hashes of halves, so the work per word grows with the logarithm of
    ``size``.
    """
    if len(words) < size:
        return np.empty(0, dtype=np.uint64)
    done, total, power = None, 0, mix(words, seed + 1)
    width, rest = 1, size
    while rest:
        if rest & 1:
            if done is None:
                done, total = power, width
            else:
                n = len(words) - total - width + 1
                done = mix(done[:n] * _STEP + power[total:total + n], seed + 2)
                total += width
        rest >>= 1
        if rest:
            n = len(power) - width
            power = mix(power[:n] * _STEP + power[width:width + n], seed + 3)
            width *= 2
    return done[: len(words) - size + 1]
