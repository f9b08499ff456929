"""Vectors turned to uncorrelated components of variance one, by block matrices.

1. Every component c of a vector becomes the whole number floor(64 c) + 1,000,000.  The fit list holds
   each distinct vector x of such numbers once: n vectors, with sums S for each dimension.
2. The centred vectors x - S/n of the fit list get gapless row numbers and become a BlockMatrix B.
   The product of its transpose with it, by n, is the covariance V, one small local matrix.
3. The eigenvectors of V, each over the root of its eigenvalue, form the matrix W.  The product of the
   BlockMatrix of all rows with W has the whitened components; row numbers lead back to the rows.
4. The covariance of the whitened fit list shows how far from the identity the result is.

A product over many rows is summed up in ``splits`` parts before one task adds the small parts, so
no task receives all blocks.  The driver holds matrices of dimensions by dimensions and block numbers.

Defined results: vectors that are NULL, empty or hold NULL or non-finite components give no rows, and
neither do those with a component beyond 2^55, whose whole number does not fit.  Vectors of each
length are fitted by themselves.  Components without variance (an eigenvalue below 10^-12 of the
largest) do not exist, so one distinct vector gives no rows.  Rows without a number keep NULL, repeated
rows count once in the fit list and are each returned.  A deviation too large for a long is NULL.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.llm.tables import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK_COLUMNS = 1024
#: Numbers in a block (8 bytes each) and blocks in a part of a product over all rows.
BLOCK_NUMBERS, BLOCKS_A_PART = 500_000, 8

_RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whole_numbers(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 of each component; NULL if the vector takes no part."""
    numbers = F.transform(vector, lambda c: c.cast("double"))
    fits = F.forall(numbers, lambda c: F.coalesce(F.abs(c) <= float(2**55), F.lit(False)) & ~F.isnan(c))
    taken = F.transform(numbers, lambda c: F.floor(c * SCALE) + SHIFT)
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & fits, taken)


def with_row_numbers(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The rows, staged, with gapless numbers ``index`` from 0, and how many there are.

    What is collected is one count for each task that wrote.
    """
    staged = written(rows.withColumn("place", F.monotonically_increasing_id()), name)
    part = F.shiftright("place", 33).cast("int")
    counts = sorted(tuple(r) for r in staged.groupBy(part.alias("part")).count().collect())
    ends = np.cumsum([n for _, n in counts], dtype=np.int64)
    firsts = [(p, int(end) - n) for (p, n), end in zip(counts, ends, strict=True)]
    offsets = staged.sparkSession.createDataFrame(firsts, "part int, first long")
    numbered = staged.withColumn("part", part).join(F.broadcast(offsets), "part")
    index = F.col("first") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn("index", index).drop("part", "first", "place"), int(ends[-1]) if len(ends) else 0


def centred(x: Column, sums: list[int], n: int) -> Column:
    """x - S/n of each dimension, from whole parts first, so that no digit is lost."""
    whole, rest = _of(sums, n)
    return F.zip_with(
        F.zip_with(x, whole, lambda a, q: (a - q).cast("double")), rest, lambda a, r: a - r.cast("double") / F.lit(float(n))
    )


def deviation(x: Column, sums: list[int], n: int) -> Column:
    """The sum over dimensions of (n x - S)^2, exact."""
    whole, rest = _of(sums, n)
    gaps = F.zip_with(
        F.zip_with(x, whole, lambda a, q: F.try_multiply(F.lit(n).cast("long"), a - q)), rest, lambda a, r: F.try_subtract(a, r)
    )
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: F.try_add(total, F.try_multiply(g, g)))


def _of(sums: list[int], n: int) -> tuple[Column, Column]:
    return tuple(F.lit([f(s) for s in sums]).cast("array<long>") for f in (lambda s: s // n, lambda s: s % n))


def block_matrix(rows: DataFrame, n: int, size: int) -> BlockMatrix:
    """Rows of ``index`` and ``vector`` (array of double) as blocks of bounded size."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("vector").alias("vector")), "vector")
    columns = min(size, BLOCK_COLUMNS)
    return IndexedRowMatrix(vectors, n, size).toBlockMatrix(max(1, BLOCK_NUMBERS // columns), columns)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The product of the transpose of a matrix of many rows with it."""
    splits = max(1, -(-matrix.numRowBlocks // BLOCKS_A_PART))
    # Only the JVM's method takes the number of parts into which the sum over the rows is split.
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    local = BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()
    return (local + local.T) / 2


def local_blocks(spark: SparkSession, matrix: np.ndarray, like: BlockMatrix) -> BlockMatrix:
    """A small matrix as blocks that can stand to the right of ``like``."""
    step = like.colsPerBlock
    blocks = [
        ((k, 0), DenseMatrix(len(own), own.shape[1], own.T.ravel()))
        for k, own in enumerate(np.split(matrix, range(step, len(matrix), step)))
    ]
    return BlockMatrix(spark.sparkContext.parallelize(blocks, len(blocks)), step, matrix.shape[1], *matrix.shape)


def row_vectors(matrix: BlockMatrix) -> DataFrame:
    """``index`` and ``vector`` of each row, without leaving the JVM as ``IndexedRowMatrix.rows`` would."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("vector"))


def _whitened(rows: DataFrame, fit: DataFrame, size: int, components: int) -> DataFrame | None:
    """The result for the vectors of one length."""
    spark = rows.sparkSession
    fit, n = with_row_numbers(fit, "fit-list")
    totals = fit.select(F.posexplode("x").alias("d", "c")).groupBy("d").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s"))
    sums = [int(row.s) for row in sorted(totals.collect(), key=lambda row: row.d)]
    matrix = block_matrix(fit.select("index", centred(F.col("x"), sums, n).alias("vector")), n, size)
    values, vectors = np.linalg.eigh(scatter(matrix) / n)
    falling = np.argsort(-values, kind="stable")[:components]
    falling = falling[values[falling] > max(values.max(), 0) * 1e-12]
    if not len(falling):
        return None
    whitening = vectors[:, falling] / np.sqrt(values[falling])
    own = scatter(matrix.multiply(local_blocks(spark, whitening, matrix))) / n
    error = float(np.abs(own - np.eye(len(falling))).max())
    explained = F.lit((values[falling] / values.sum()).tolist())

    numbered, n_rows = with_row_numbers(rows, "whole-number-vectors")
    every = block_matrix(numbered.select("index", centred(F.col("x"), sums, n).alias("vector")), n_rows, size)
    projected = row_vectors(every.multiply(local_blocks(spark, whitening, every)))
    return (
        numbered.select("index", "vec_id", deviation(F.col("x"), sums, n).alias("deviation"))
        .join(projected, "index")
        .select("vec_id", "deviation", F.posexplode("vector").alias("k", "whitened"))
        .select(
            "vec_id",
            (F.col("k") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("k")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )


def whitened(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row for each vector and component: ``vec_id``, ``component`` (from 1, by falling eigenvalue), ``n``,
    ``deviation`` (the sum over dimensions of (n x - S)^2), ``whitened``, ``explained`` (the eigenvalue's share
    of the trace) and ``identity_error`` (the largest entry of the whitened covariance less the identity)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col)).alias("x"))
    rows = written(rows.filter("x is not null"), "vectors")
    fit = rows.select("x").distinct()
    # One pass per length; a table of vectors has one, or few where it holds faulty ones.
    sizes = sorted(r.size for r in rows.select(F.size("x").alias("size")).distinct().collect())
    found = [
        _whitened(rows.filter(F.size("x") == size), fit.filter(F.size("x") == size), size, components) for size in sizes
    ]
    empty = vectors.sparkSession.createDataFrame([], _RESULT)
    return reduce(DataFrame.unionByName, [f for f in found if f is not None], empty)
