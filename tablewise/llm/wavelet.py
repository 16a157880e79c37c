"""A wavelet matrix over small symbols, with rank and select for many
positions at once."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits with the number of ones before any position."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(-(-len(bits) // 64) + 1, "<u8")
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletMatrix:
    """Level k splits the symbols by their k-th highest bit: zeros go before
    ones, in order. A symbol's occurrences are a range after the last level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.size, self.bits, self.levels = len(symbols), bits, []
        for shift in reversed(range(bits)):
            bit = (symbols >> shift & 1).astype(bool)
            self.levels.append(BitVector(bit))
            if shift:
                symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before each position."""
        first = np.zeros(1, np.int64)
        for level, shift in zip(self.levels, reversed(range(self.bits))):
            a, b = level.ones(at), level.ones(first)
            if symbol >> shift & 1:
                at, first = level.zeros + a, level.zeros + b
            else:
                at, first = at - a, first - b
        return at - first

    def count(self, symbols: list[int], at: np.ndarray) -> np.ndarray:
        """Occurrences of any of ``symbols`` before each position."""
        return sum((self.rank(s, at) for s in symbols), np.zeros(len(at), np.int64))

    def select(self, symbols: list[int], nth: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest position p of [low, high] with ``nth`` occurrences of
        any of ``symbols`` before p + 1 (``high`` if there are fewer before
        it), by bisection on ranks, for all at once."""
        low, high = low.copy(), high.copy()
        while True:
            active = low < high
            if not active.any():
                return low
            mid = (low + high) >> 1
            enough = np.ones(len(low), bool)
            enough[active] = self.count(symbols, mid[active] + 1) >= nth[active]
            high = np.where(active & enough, mid, high)
            low = np.where(active & ~enough, mid + 1, low)
