"""Texts as numpy arrays of code points, for work on whole Arrow batches."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@cache
def kinds() -> np.ndarray:
    """For each code point: letter, number, white space or other."""
    kind = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000
    )
    # The Unicode property White_Space.
    for low, high in ((9, 13), (32, 32), (133, 133), (160, 160), (0x1680, 0x1680), (0x2000, 0x200A),
                      (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        table[low : high + 1] = SPACE
    return table


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def span_hashes(chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit number for each stretch of ``chars`` that begins at ``starts`` and ends at the next."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(chars)))
    place = np.arange(len(chars), dtype=np.uint64) - np.repeat(starts.astype(np.uint64), lengths)
    return np.add.reduceat(mixed(chars.astype(np.uint64) + (place << np.uint64(24)) + np.uint64(1)), starts)


def batched(rows: Iterable[tuple], size_of, limit: int) -> Iterator[list[tuple]]:
    """Rows in lists whose sizes add up to about ``limit``; a larger row has a list of its own."""
    held, total = [], 0
    for row in rows:
        size = size_of(row)
        if held and total + size > limit:
            yield held
            held, total = [], 0
        held.append(row)
        total += size
    if held:
        yield held
