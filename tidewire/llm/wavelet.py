"""A wavelet matrix over small classes, with rank queries for many positions at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Bits:
    """Ranks over a row of bits: a running count per word of 64 and a population count inside the word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        room = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)  # one word past the last bit at least
        room[:len(packed)] = packed
        self.words = room.view("<u8")
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, ends: np.ndarray) -> np.ndarray:
        """How many of the first ``ends`` bits are set."""
        word = ends >> 6
        low = ~(_ALL << (ends & 63).astype(np.uint64))
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Classes below ``2 ** levels``, one row of bits per level, each level sorted stably by the bit above it."""

    def __init__(self, classes: np.ndarray, levels: int):
        self.levels: list[tuple[int, Bits, int]] = []
        row = classes.astype(np.uint8)
        for shift in reversed(range(levels)):
            bits = (row >> np.uint8(shift)) & np.uint8(1)
            ones = bits.astype(bool)
            self.levels.append((shift, Bits(bits), len(row) - int(np.count_nonzero(ones))))
            row = np.concatenate([row[~ones], row[ones]])

    def rank(self, kind: int, ends: np.ndarray) -> np.ndarray:
        """How many of the first ``ends`` classes are ``kind``."""
        first, ends = np.zeros(1, dtype=np.int64), ends.astype(np.int64)
        for shift, bits, zeros in self.levels:
            if kind >> shift & 1:
                first, ends = zeros + bits.ones(first), zeros + bits.ones(ends)
            else:
                first, ends = first - bits.ones(first), ends - bits.ones(ends)
        return ends - first

    def count(self, kinds: Sequence[int], ends: np.ndarray) -> np.ndarray:
        """How many of the first ``ends`` classes are among ``kinds``: the sum of their ranks."""
        return sum((self.rank(kind, ends) for kind in kinds), np.zeros(len(ends), dtype=np.int64))

    def reach(self, kinds: Sequence[int], starts: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """For each range the least end that has ``wanted`` classes of ``kinds`` behind its start, by bisection on ranks.

        A range with fewer gives its own end.
        """
        goal = self.count(kinds, starts) + wanted
        low, high = starts.astype(np.int64), ends.astype(np.int64)
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.count(kinds, middle) >= goal
            low, high = np.where(enough, low, np.minimum(middle + 1, high)), np.where(enough, middle, high)
        return low
