"""A wavelet matrix in numpy: how often each symbol occurs before any place of a sequence."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class WaveletMatrix:
    """Symbols of ``bits`` bits, kept as one bit vector for each bit, the highest first.

    A level holds the bits of the symbols in the order of the level: those with a 0 at the level
    before come first, both halves in their old order.  Beside the bits only the ones before each
    word of 64 are kept, so a sequence takes about ``bits * 1.25 / 8`` bytes a symbol.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.size, self.bits, self.levels = len(symbols), bits, []
        for bit in reversed(range(bits)):
            ones = (symbols >> bit) & 1 == 1
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
            zeros = len(symbols) - int(np.count_nonzero(ones))
            self.levels.append((words, before, zeros))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    @staticmethod
    def _ones(level: tuple, places: np.ndarray) -> np.ndarray:
        words, before, _ = level
        at = places >> 6
        inside = words[at] & ((np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1))
        return before[at] + np.bitwise_count(inside)

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How many of the first ``places`` symbols are ``symbol``."""
        start, end = np.int64(0), places
        for bit, level in zip(reversed(range(self.bits)), self.levels, strict=True):
            if symbol >> bit & 1:
                start, end = level[2] + self._ones(level, start), level[2] + self._ones(level, end)
            else:
                start, end = start - self._ones(level, start), end - self._ones(level, end)
        return end - start

    def count(self, symbols: Iterable[int], places: np.ndarray) -> np.ndarray:
        """How many of the first ``places`` symbols are among ``symbols``."""
        return sum((self.rank(s, places) for s in symbols), np.zeros(len(places), np.int64))

    def find(self, symbols: Iterable[int], wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of the symbol number ``wanted`` (from 1, counted from the very start) among ``symbols``,
        sought in ``low`` to ``high`` by halving; ``high`` where there is none."""
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            enough = self.count(symbols, middle + 1) >= wanted[open_]
            high[open_[enough]] = middle[enough]
            low[open_[~enough]] = middle[~enough] + 1
        return low
