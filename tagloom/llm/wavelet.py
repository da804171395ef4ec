"""A wavelet matrix over small symbols, for many rank and select queries at once."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_SIX = np.uint64(6)


class Bits:
    """A bit vector with the number of set bits before every word of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate((packed, np.zeros(16 - len(packed) % 8, np.uint8))).view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, stops: np.ndarray) -> np.ndarray:
        """How many bits are set before each of ``stops``."""
        at = stops.astype(np.uint64)
        word = at >> _SIX
        mask = (_ONE << (at & np.uint64(63))) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Symbols below ``2 ** levels``: each level holds one bit of every symbol, highest first, and puts
    symbols with a 0 before those with a 1, otherwise in their order.  A level takes 2 bits a symbol."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.size, self.levels = len(symbols), levels
        self.rows: list[Bits] = []
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.rows.append(Bits(bit.astype(np.uint8)))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: int, stops: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each of ``stops``."""
        first, last = np.zeros_like(stops), stops
        for row, level in zip(self.rows, range(self.levels - 1, -1, -1)):
            a, b = row.ones(first), row.ones(last)
            first, last = (a + row.zeros, b + row.zeros) if symbol >> level & 1 else (first - a, last - b)
        return last - first

    def count(self, symbols, stops: np.ndarray) -> np.ndarray:
        """How many of ``symbols`` occur before each of ``stops``: their ranks added up."""
        return sum((self.rank(s, stops) for s in symbols), np.zeros_like(stops))

    def select(self, symbols, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For each of ``wanted``, the least stop from ``low`` to ``high`` before which so many of ``symbols`` occur.

        By bisection on ranks, all queries at once; ``high`` where there are fewer.
        """
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = self.count(symbols, middle[open_]) >= wanted[open_]
            at = np.flatnonzero(open_)
            high[at[enough]] = middle[at[enough]]
            low[at[~enough]] = middle[at[~enough]] + 1
        return low
