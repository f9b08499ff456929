"""Nearest neighbours with a forest of random-projection trees.

The trees are grown on a bounded sample: each node splits its vectors at the
median of their projections on a random direction.  Every vector is then
passed down all trees and filed under a leaf of each.  A query walks all trees
at once: one priority queue holds the branches not taken yet, ordered by the sum
of the squared distances to the splits that a branch crosses, and the least
branch of any tree goes next, until enough leaves are open.  In each open leaf the
exact cosines are computed and the best few of the leaf go on, so what is shuffled
is bounded by leaves per query, however full the leaves are.  Crowded leaves are
dealt out in blocks.

How deep the trees are follows from the number of vectors, and how many leaves a
query opens from the vectors themselves: on the sample, where the nearest are
known by comparing all, as many as find ``RECALL`` of them.  Where vectors lie in
groups that is a small part of the leaves; where they have no structure, nearest
neighbours are spread over most of them and no index of this kind saves much.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite
components take no part, as queries or as candidates.  Vectors of each length have
a forest of their own and are near to none of another.  Rows without a number take
no part.  Rows that share a number are one candidate with the best of their scores.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktally.llm.tables import written
from clicktally.llm.vectors import matrices, unpacked

#: Trees grow on at most so many vectors of a length (and bytes of unit vectors), those with the smallest hashes of
#: their numbers.
SAMPLE_ROWS, SAMPLE_BYTES = 65_536, 64_000_000
#: Leaves of about ``LEAF_ROWS`` vectors, as far as the sample leaves ``LEAF_SAMPLE_ROWS`` for each.
TREES, LEAF_ROWS, LEAF_SAMPLE_ROWS = 8, 256, 16
#: The share of the nearest in the sample that opened leaves have to hold, and how many queries measure it.
RECALL, TRIALS = 0.97, 128
#: Neighbouring leaves of a tree are worked on together up to about so many vectors; larger leaves are cut up.
PIECE_ROWS = 4096
#: Each length of vectors takes a sample and a forest on the driver.
MAX_LENGTHS = 64

_FILED = "size int, piece int, leaf int, id long, vector binary"
_ASKED = "size int, piece int, leaves array<int>, id long, vector binary"
_FOUND = "query_id long, vec_id long, score double"


class Forest:
    """Complete trees of one depth; node k of a tree has the children 2k + 1 and 2k + 2."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.depth, self.trees, self.inner = depth, trees, (1 << depth) - 1
        self.ways = rng.standard_normal((trees, self.inner, sample.shape[1]))
        self.ways /= np.linalg.norm(self.ways, axis=2, keepdims=True)
        self.cuts = np.zeros((trees, self.inner))
        for t in range(trees):
            held = {0: sample}
            for node in range(self.inner):
                own = held.pop(node)
                along = own @ self.ways[t, node]
                self.cuts[t, node] = np.median(along) if len(along) else 0.0
                right = along > self.cuts[t, node]
                held[2 * node + 1], held[2 * node + 2] = own[~right], own[right]

    def leaves(self, units: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree; leaves of all trees are numbered through."""
        out = np.empty((len(units), self.trees), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(units), np.int64)
            for _ in range(self.depth):
                along = np.einsum("ij,ij->i", units, self.ways[t, node])
                node = 2 * node + 1 + (along > self.cuts[t, node])
            out[:, t] = node - self.inner + (t << self.depth)
        return out

    def search(self, unit: np.ndarray, open_leaves: int) -> list[int]:
        """The leaves to open for a query, over one queue of the branches of all trees."""
        margin = self.ways @ unit - self.cuts
        queue = [(0.0, t, 0) for t in range(self.trees)]
        found = []
        while queue and len(found) < open_leaves:
            far, t, node = heapq.heappop(queue)
            while node < self.inner:
                side = margin[t, node]
                near, other = (2, 1) if side > 0 else (1, 2)
                heapq.heappush(queue, (far + side * side, t, 2 * node + other))
                node = 2 * node + near
            found.append(node - self.inner + (t << self.depth))
        return found


    def costs(self, unit: np.ndarray) -> np.ndarray:
        """What the queue asks for each leaf of each tree."""
        margin = self.ways @ unit - self.cuts
        cost = np.zeros((self.trees, 1))
        for level in range(self.depth):
            own = margin[:, (1 << level) - 1 : (2 << level) - 1]
            sides = cost + np.maximum(own, 0) ** 2, cost + np.maximum(-own, 0) ** 2
            cost = np.stack(sides, axis=2).reshape(self.trees, -1)
        return cost.ravel()


def depth_for(rows: int, sample_rows: int) -> int:
    """The depth of the trees for so many vectors, a sample of which is at hand."""
    return max(1, min(math.ceil(math.log2(max(rows, 2) / LEAF_ROWS)), int(math.log2(max(sample_rows / LEAF_SAMPLE_ROWS, 2)))))


def leaves_to_open(forest: Forest, sample: np.ndarray, k: int, recall: float = RECALL, trials: int = TRIALS) -> int:
    """So many leaves that a vector of the sample finds that share of its ``k`` nearest in the sample."""
    total = forest.trees << forest.depth
    asked, k = sample[:trials], min(k, len(sample) - 1)
    if k < 1:
        return total
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    nearest_ = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    filed, needed = forest.leaves(sample), []
    for unit, own in zip(asked, nearest_, strict=True):
        turn = np.empty(total, np.int64)
        turn[np.argsort(forest.costs(unit), kind="stable")] = np.arange(1, total + 1)
        needed.append(turn[filed[own]].min(axis=1))
    return int(np.quantile(np.concatenate(needed), recall, method="higher"))


def _pieces_of(leaves: np.ndarray, forest: Forest, rows: int) -> np.ndarray:
    """The subtree of about ``PIECE_ROWS`` of all vectors that each leaf belongs to."""
    depth = min(forest.depth, max(0, math.floor(math.log2(max(rows / PIECE_ROWS, 1)))))
    return leaves >> (forest.depth - depth)


def _filed(sent) -> Callable:
    """Each vector under its leaf of each tree."""

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, units in matrices(batch):
                if (size := units.shape[1]) in sent.value:
                    forest, _, total = sent.value[size]
                    leaves = forest.leaves(units).ravel()
                    rows = np.repeat(np.arange(len(ids)), forest.trees)
                    blobs = np.array([u.tobytes() for u in units], dtype=object)
                    yield pa.record_batch(
                        [pa.array(np.full(len(rows), size, np.int32)), pa.array(_pieces_of(leaves, forest, total), pa.int32()),
                         pa.array(leaves, pa.int32()), pa.array(ids[rows]), pa.array(blobs[rows], pa.binary())],
                        names=["size", "piece", "leaf", "id", "vector"],
                    )

    return filed


def _asked(sent) -> Callable:
    """Each query once in each piece it opens leaves of, with these leaves."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, units in matrices(batch):
                if (size := units.shape[1]) not in sent.value:
                    continue
                forest, open_leaves, total = sent.value[size]
                out = ([], [], [], [])
                for i, unit in zip(ids.tolist(), units, strict=True):
                    leaves = np.sort(np.array(forest.search(unit, open_leaves), np.int32))
                    pieces, starts = np.unique(_pieces_of(leaves, forest, total), return_index=True)
                    out[0].extend(pieces.tolist())
                    out[1].extend(np.split(leaves, starts[1:]))
                    out[2].extend([i] * len(pieces))
                    out[3].extend([unit.tobytes()] * len(pieces))
                kinds = (pa.int32(), pa.list_(pa.int32()), pa.int64(), pa.binary())
                yield pa.record_batch(
                    [pa.array(np.full(len(out[0]), size, np.int32)), *map(pa.array, out, kinds)],
                    names=["size", "piece", "leaves", "id", "vector"],
                )

    return asked


def _best_of_leaf(k: int) -> Callable:
    def best(rows: pa.Table, queries: pa.Table) -> pa.Table:
        """The ``k`` nearest rows of one block of a leaf to each query that opened it."""
        ids, asked = rows.column("id").to_numpy(), queries.column("id").to_numpy()
        out = ([], [], [])
        if len(ids) and len(asked):
            units, wanted = unpacked(rows.column("vector").to_pylist()), unpacked(queries.column("vector").to_pylist())
            order = np.argsort(ids, kind="stable")
            ids, units = ids[order], units[order]
            repeated = bool((ids[1:] == ids[:-1]).any())
            for at in range(0, len(asked), 256):
                scores = wanted[at : at + 256] @ units.T
                scores[asked[at : at + 256, None] == ids] = -np.inf
                # Rounding differs between block shapes, so what may be among the best is scored by itself and then cut.
                margin = 8 * units.shape[1] * np.finfo(units.dtype).eps
                if repeated:
                    margin = np.inf  # the best rows may be all of one number
                last = np.partition(scores, -k, axis=1)[:, -k] if k < len(ids) else np.full(len(scores), -np.inf)
                for n, (q, row) in enumerate(zip(asked[at : at + 256].tolist(), scores, strict=True)):
                    own = np.flatnonzero((row >= last[n] - margin) & (row > -np.inf))
                    exact = (units[own] * wanted[at + n]).sum(axis=1)
                    best_first = np.lexsort((ids[own], -exact))
                    if repeated:
                        best_first = best_first[np.sort(np.unique(ids[own][best_first], return_index=True)[1])]
                    own, exact = own[best_first[:k]], exact[best_first[:k]]
                    out[0].extend([q] * len(own))
                    out[1].extend(ids[own].tolist())
                    out[2].extend(exact.tolist())
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})

    return best


def _best_of_piece(k: int) -> Callable:
    """The ``k`` nearest rows of the opened leaves of one block of a piece to each query."""
    best_of_leaf = _best_of_leaf(k)

    def best(rows: pa.Table, queries: pa.Table) -> pa.Table:
        leaf = rows.column("leaf").to_numpy()
        order = np.argsort(leaf, kind="stable")
        opened = queries.column("leaves").to_pylist()
        asked_leaf = np.array([x for own in opened for x in own], np.int32)
        asker = np.repeat(np.arange(len(opened)), [len(own) for own in opened])
        found = [best_of_leaf(rows.slice(0, 0), queries.slice(0, 0))]
        for x in np.unique(asked_leaf).tolist():
            low, high = np.searchsorted(leaf[order], [x, x + 1])
            if low < high:
                found.append(best_of_leaf(rows.take(order[low:high]), queries.take(asker[asked_leaf == x])))
        all_ = pa.concat_tables(found)
        query, vec, score = (all_.column(c).to_numpy() for c in ("query_id", "vec_id", "score"))
        order = np.lexsort((-score, vec, query))
        pairs = np.stack([query[order], vec[order]])
        order = order[np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))[: len(order)]]
        order = order[np.lexsort((vec[order], -score[order], query[order]))]
        query = query[order]
        starts = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
        place = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
        return all_.take(order[place < k])

    return best


def _grown(rows: DataFrame, k: int, trees: int, sample_rows: int) -> dict[int, tuple[Forest, int, int]]:
    """A forest, the number of leaves to open and that of vectors for each length of vectors, from at most ``sample_rows`` of each."""
    sized = rows.filter("id is not null and vector is not null").withColumn("size", F.size("vector"))
    counts = {r["size"]: r["count"] for r in sized.groupBy("size").count().limit(MAX_LENGTHS + 1).collect()}
    if len(counts) > MAX_LENGTHS:
        raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths")
    # Spark limits each length to that many rows before it shuffles for this.
    order = Window.partitionBy("size").orderBy(F.xxhash64("id"), "id")
    most = F.least(F.lit(sample_rows), F.floor(SAMPLE_BYTES / (8 * F.greatest("size", F.lit(1)))))
    drawn = (
        sized.withColumn("place", F.row_number().over(order))
        .filter((F.col("place") <= sample_rows) & (F.col("place") <= most))
        .select("id", "vector")
    )
    sample: dict[int, list[np.ndarray]] = {}
    for batch in drawn.toArrow().to_batches():
        for _, units in matrices(batch):
            sample.setdefault(units.shape[1], []).append(units)
    grown = {}
    for size, parts in sample.items():
        units = np.concatenate(parts)
        forest = Forest(units, trees, depth_for(counts[size], len(units)))
        # Few vectors are compared with all.
        opened = leaves_to_open(forest, units, k) if counts[size] > LEAF_ROWS else trees << forest.depth
        grown[size] = (forest, max(trees, opened), counts[size])
    return grown


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest found for each query.

    Queries are the rows that ``is_query`` holds for, candidates all rows but
    the query's own number; nearness is the cosine, ties go to the smaller
    number.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    asked = vectors.filter(is_query).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    grown = _grown(rows, k, trees, sample_rows)
    if not grown:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sent = spark.sparkContext.broadcast(grown)

    filed = written(rows.mapInArrow(_filed(sent), _FILED), "leaves")
    # As many rows as there are pieces of trees, whatever the number of vectors.
    piece = ["size", "piece"]
    blocks = filed.groupBy(*piece).agg(F.ceil(F.count(F.lit(1)) / (2 * PIECE_ROWS)).cast("int").alias("blocks"))
    blocks = F.broadcast(written(blocks, "leaf-blocks"))
    dealt = filed.join(blocks, piece).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    opened = (
        asked.mapInArrow(_asked(sent), _ASKED)
        .join(blocks, piece)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .drop("blocks")
    )
    block = [*piece, "block"]
    found = dealt.groupBy(*block).cogroup(opened.groupBy(*block)).applyInArrow(_best_of_piece(k), _FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # Spark limits each query to k rows before it shuffles for this.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
