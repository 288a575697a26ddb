"""Bloom filters of bounded size, set by tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normalake.llm._text import mix

#: A filter has so many bits (8 MB) at most; one that is full lets more through and misses nothing.
BITS = 1 << 26
_U = np.uint64


class Bloom:
    """Which 64-bit hashes are in a set; none of it is missed."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __call__(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for at in bloom_bits(h, len(self.words) * 64):
            found &= (self.words[at >> 6] >> (at & 63).astype(_U) & _U(1)).astype(bool)
        return found

    @classmethod
    def of(cls, rows: DataFrame, bits: int) -> Bloom:
        """rows (place, bits) of set_bits(), put together by Spark; the filter
        comes to the driver."""
        found = rows.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
        words = np.zeros(bits // 64, _U)
        words[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(_U)
        return cls(words)


def bloom_bits(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Each hash's three places among so many (a power of 2)."""
    return [(mix(h + _U(k)) & _U(bits - 1)).astype(np.int64) for k in range(3)]


def set_bits(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Which words of a filter hashes set, and the bits they set there."""
    at = np.unique(np.concatenate(bloom_bits(h, bits)))
    place, first = np.unique(at >> 6, return_index=True)
    words = np.bitwise_or.reduceat(_U(1) << (at & 63).astype(_U), first) if len(at) else np.zeros(0, _U)
    return place, words.view(np.int64)
