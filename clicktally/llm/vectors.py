"""Vectors in Arrow batches as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers and unit vectors (double) of the rows of a batch (a number, a list), for each length.

    Vectors that are NULL, zero, or hold NULL or non-finite components take no
    part, and neither do rows without a number.
    """
    for ids, block in given(batch):
        yield ids, units(block)


def units(block: np.ndarray) -> np.ndarray:
    block = block / np.abs(block).max(axis=1)[:, None]  # so that no square overflows
    return block / np.sqrt((block * block).sum(axis=1))[:, None]


def given(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As ``matrices``, the vectors as they are."""
    lists = batch.column(1)
    present = np.flatnonzero(np.asarray(lists.is_valid()) & np.asarray(batch.column(0).is_valid()))
    if not len(present):
        return
    lists = lists.take(pa.array(present))
    ids = batch.column(0).take(pa.array(present)).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        block = values[starts[rows, None] + np.arange(size)]
        peak = np.abs(block).max(axis=1)
        good = np.isfinite(peak) & (peak > 0)
        yield ids[rows[good]], block[good]


def packed(block: np.ndarray) -> list[bytes]:
    """Each row as floats where that loses nothing, else as doubles."""
    with np.errstate(over="ignore"):
        short = block.astype(np.float32)
    fits = (short == block).all(axis=1)
    return [(s if f else d).tobytes() for s, d, f in zip(short, block, fits.tolist(), strict=True)]


def unpacked(blobs: list[bytes], size: int | None = None) -> np.ndarray:
    """The rows of ``packed``, all of ``size`` components; without it all rows are doubles."""
    if not blobs:
        return np.zeros((0, 0))
    if size is None or {len(b) for b in blobs} == {8 * size}:
        return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    return np.array([np.frombuffer(b, np.float32 if len(b) == 4 * size else np.float64) for b in blobs], np.float64)
