"""Wavelet matrices over integer arrays, for many queries at a time (helpers inside Spark tasks).

Each level holds one bit of every value, packed, with a running count for each 64 bits.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


class Bits:
    """A bit vector with rank: about 1.5 bits of memory for each bit."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """How many of the first ``i`` bits are set."""
        word = i >> 6
        mask = (_U(1) << (i & 63).astype(np.uint64)) - _U(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank, order statistics and successors of the values in ranges ``[lo, hi)``."""

    def __init__(self, values: np.ndarray, top: int):
        self.width = max(1, int(top).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        values = np.asarray(values)
        for b in range(self.width - 1, -1, -1):
            bit = (values >> b) & 1 == 1
            self.levels.append((Bits(bit), len(values) - int(bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])

    def place(self, value: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the next ``value`` at or after place ``i`` stands once the values are sorted by their bits."""
        for b, (bits, zeros) in zip(range(self.width - 1, -1, -1), self.levels):
            ones = bits.rank(i)
            i = np.where((value >> b) & 1 == 1, zeros + ones, i - ones)
        return i

    def count_below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values in the range are below ``value`` (at most 2 ** width)."""
        below = np.where(value >> self.width > 0, hi - lo, 0)
        for b, (bits, zeros) in zip(range(self.width - 1, -1, -1), self.levels):
            one_lo, one_hi = bits.rank(lo), bits.rank(hi)
            up = (value >> b) & 1 == 1
            below = below + np.where(up & (value >> self.width == 0), (hi - one_hi) - (lo - one_lo), 0)
            lo, hi = np.where(up, zeros + one_lo, lo - one_lo), np.where(up, zeros + one_hi, hi - one_hi)
        return below

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank ``k`` (from 0) among those of the range, which must have more than ``k``."""
        out = np.zeros(len(lo), np.int64)
        for b, (bits, zeros) in zip(range(self.width - 1, -1, -1), self.levels):
            one_lo, one_hi = bits.rank(lo), bits.rank(hi)
            low = (hi - one_hi) - (lo - one_lo)
            up = k >= low
            out = np.where(up, out | (1 << b), out)
            k = np.where(up, k - low, k)
            lo, hi = np.where(up, zeros + one_lo, lo - one_lo), np.where(up, zeros + one_hi, hi - one_hi)
        return out
