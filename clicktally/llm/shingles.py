"""Words of texts and the hashes of their shingles, a whole Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from clicktally.llm.codepoints import batched, mixed, points, span_hashes

BLOCK_CHARS = 1_000_000


def _is_gap(chars: np.ndarray) -> np.ndarray:
    return (chars == 0x20) | ((chars >= 9) & (chars <= 13))


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """For each text the hashes of its words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, in order."""
    chars = points("\n".join(texts) + "\n")
    gap = _is_gap(chars)
    chars = np.where((chars >= 65) & (chars <= 90), chars + 32, chars)
    opens = np.flatnonzero(np.append(True, gap[1:] != gap[:-1]))
    words = opens[~gap[opens]]
    hashes = span_hashes(chars, opens)[~gap[opens]]
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.split(hashes, np.searchsorted(words, ends[:-1]))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; fewer words make one run together, none make none."""
    size = min(size, len(words))
    if not size:
        return words[:0]
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        runs = mixed(words[:n])
        for k in range(1, size):
            runs = mixed(runs * np.uint64(31) + words[k : k + n])
    return runs


def texts_with_words(batches: Iterator) -> Iterator[tuple]:
    """Key and word hashes of each row of Arrow batches whose columns are a key and a text."""
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for block in batched(rows, lambda row: len(row[1]), BLOCK_CHARS):
            yield from zip([row[0] for row in block], word_hashes([row[1] for row in block]), strict=True)
