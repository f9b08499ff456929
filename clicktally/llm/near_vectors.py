"""Near-duplicate vectors by counting collisions of one-dimensional projections.

All vectors are projected on the same ``PROJECTIONS`` directions.  Two vectors
collide in a projection if one lies in the window around the other.  A pair
that collides often enough is a candidate, and its cosine is computed.  The
width of the window and the number asked for are set so that a pair at the
threshold is missed with a probability of about one in ten thousand.

Counting for every pair would compare all with all.  So sorted projections are
cut into slabs, a table combines the slabs of a few projections into cells,
and pairs are counted within cells only.  Enough tables, each with projections
and cuts of its own, are used for a pair at the threshold to share a cell in
one of them.  With the number of vectors n a cell combines more projections,
so that cells keep their size, and there are more tables: work grows as about
n^1.3.

Equal vectors form a class that stands once in every table.  Crowded cells are
cut into blocks and compared block by block; what leaves a block is the number
of links of each vector and a tree over them, never the pairs.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite
components, and vectors of different lengths, are linked with nothing.  Rows
that share a number are taken together.  A row without a number is linked with
nothing and kept.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.blocks import block_pairs, local_roots, pieces, sides
from clicktally.llm.codepoints import mixed
from clicktally.llm.components import components
from clicktally.llm.tables import written
from clicktally.llm.vectors import given, packed, units, unpacked

PROJECTIONS = 32
CELL_ROWS = 100
#: What vectors that are compared have in common: their length, and a cell of a table.
KEYS = ["size", "t", "cell"]

_CLASSED = "id long, digest binary, size int, vector binary"
_PLACED = "id long, n long, size int, vector binary, projected binary, cells array<long>"
_FOUND = "id long, n long, root long"


def directions(size: int) -> np.ndarray:
    """``PROJECTIONS`` random unit vectors of a length, always the same."""
    made = np.random.default_rng(size).standard_normal((size, PROJECTIONS))
    return made / np.linalg.norm(made, axis=0)


def plan(n: int, size: int, threshold: float, miss: float = 1e-3) -> dict:
    """How to look for pairs at ``threshold`` among ``n`` vectors of a length.

    A difference of two unit vectors at that cosine has the length sqrt(2 - 2 threshold); its projection
    is taken as normal.  Slabs are four and a half standard deviations wide.
    """
    spread = math.sqrt(2 - 2 * threshold) / math.sqrt(size)
    wide = math.sqrt(2) / math.sqrt(size)
    width = 4.5 * spread
    same = 1 - math.sqrt(2 / math.pi) * spread / width
    apart = max(0.05, 1 - math.sqrt(2 / math.pi) * min(wide / width, 1.2))
    combined = max(1, min(PROJECTIONS, math.ceil(math.log(max(n, 2) / CELL_ROWS) / -math.log(apart))))
    tables = math.ceil(math.log(miss) / math.log(1 - same**combined)) if same**combined < 1 - miss else 1
    inside = math.erf(2.2 / math.sqrt(2))
    least = PROJECTIONS * inside - 4 * math.sqrt(PROJECTIONS * inside * (1 - inside))
    return {"width": width, "combined": combined, "tables": tables, "window": 2.2 * spread, "least": math.floor(least)}


def cell_keys(projected: np.ndarray, how: dict) -> np.ndarray:
    """The cell of each vector (its projections as floats) in each table, as 64-bit numbers."""
    rng = np.random.default_rng(7)
    projected = projected.astype(np.float64)
    keys = np.empty((len(projected), how["tables"]), np.int64)
    with np.errstate(over="ignore"):
        for t in range(how["tables"]):
            chosen = rng.permutation(PROJECTIONS)[: how["combined"]]
            slab = np.floor(projected[:, chosen] / how["width"] + rng.random(len(chosen))).astype(np.int64)
            key = np.full(len(projected), t + 1, np.uint64)
            for column in slab.T:
                key = mixed(key * np.uint64(31) + column.astype(np.uint64))
            keys[:, t] = key.view(np.int64)
    return keys


def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, block in given(batch):
            size = block.shape[1]
            digests = [hashlib.md5(u.tobytes()).digest() for u in units(block)]
            yield pa.record_batch(
                [pa.array(ids), pa.array(digests, pa.binary()), pa.array([size] * len(ids), pa.int32()),
                 pa.array(packed(block), pa.binary())],
                names=["id", "digest", "size", "vector"],
            )


def _placed(how: dict[int, dict]) -> Callable:
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs, sizes = batch.column("vector").to_pylist(), batch.column("size").to_numpy()
            keys, places = [None] * len(blobs), [None] * len(blobs)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size).tolist()
                projected = (units(unpacked([blobs[i] for i in rows], size)) @ directions(size)).astype(np.float32)
                for i, own, place in zip(rows, cell_keys(projected, how[size]), projected, strict=True):
                    keys[i], places[i] = own, place.tobytes()
            yield pa.record_batch(
                [*(batch.column(c) for c in ("id", "n", "size", "vector")), pa.array(places, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "n", "size", "vector", "projected", "cells"],
            )

    return placed


def _links_of(group: list[dict], threshold: float, how: dict[int, dict]) -> list[tuple[int, int, int]]:
    """``id``, number of links and local root of each row of one block pair that has a link."""
    size, table = group[0]["size"], group[0]["t"]
    rule = how[size]
    ids = np.array([row["id"] for row in group])
    counts = np.array([row["n"] for row in group])
    projected = np.frombuffer(b"".join(row["projected"] for row in group), np.float32).reshape(len(group), -1)
    vectors = cells = None
    x, y, same = sides(group)
    firsts, seconds = [], []
    step = max(1, 1_000_000 // (PROJECTIONS * max(len(y), 1)))
    for at in range(0, len(x), step):
        some = x[at : at + step]
        near = np.abs(projected[some, None, :] - projected[None, y, :]) <= np.float32(rule["window"])
        p, q = np.nonzero(near.sum(axis=2) >= rule["least"])
        p, q = some[p], y[q]
        if same:
            p, q = p[p < q], q[p < q]
        if not len(p):
            continue
        vectors = units(unpacked([row["vector"] for row in group], size)) if vectors is None else vectors
        linked = np.einsum("ij,ij->i", vectors[p], vectors[q]) >= threshold
        p, q = p[linked], q[linked]
        cells = cell_keys(projected, rule) if cells is None else cells
        new = ~(cells[p, :table] == cells[q, :table]).any(axis=1)  # else an earlier table has counted it
        firsts.append(p[new])
        seconds.append(q[new])
    p, q = np.concatenate([*firsts, x[:0]]), np.concatenate([*seconds, x[:0]])
    total = np.bincount(p, counts[q], len(ids)) + np.bincount(q, counts[p], len(ids))
    root = local_roots(ids, p, q)
    return [(int(ids[k]), int(total[k]), int(root[k])) for k in np.flatnonzero(total)]


def _counted(threshold: float, how: dict[int, dict]) -> Callable:
    """Over batches sorted by table, cell and block pair: the links of each block pair."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, KEYS):
            found = _links_of(piece, threshold, how)
            ids, counts, roots = zip(*found, strict=True) if found else ([], [], [])
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(roots, pa.int64())],
                                  names=["id", "n", "root"])

    return counted


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``: one row per row of ``vectors``.

    ``n_links``: other vectors at a cosine of at least ``threshold``;
    ``component_id``: the smallest number that links reach; ``kept``: whether
    that is the vector itself.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    classed = written(rows.mapInArrow(_classed, _CLASSED), "unit-vectors")
    classes = written(
        classed.groupBy("digest").agg(
            F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("size").alias("size"), F.min("vector").alias("vector")
        ),
        "vector-classes",
    )
    lengths = classes.groupBy("size").count().limit(10_000).collect()
    how = {row["size"]: plan(row["count"], row["size"], threshold) for row in lengths}
    placed = written(classes.mapInArrow(_placed(how), _PLACED), "vector-cells")
    cells = placed.select("id", "size", F.posexplode("cells").alias("t", "cell"), F.lit(1).alias("weight"))
    met = block_pairs(cells, KEYS, placed.drop("size", "cells"))
    found = written(met.mapInArrow(_counted(threshold, how), _FOUND), "vector-links")
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    totals = found.groupBy("id").agg(F.sum("n").alias("links"))
    answers = (
        classes.drop("vector", "size")
        .join(totals, "id", "left")
        .join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component_id", "id").alias("component_id"))
    )
    linked = (
        classed.select("id", "digest")
        .join(answers, "digest")
        .groupBy("id")
        .agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    )
    return rows.select("id").join(linked, "id", "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
    )
