"""Comparing the members of groups with each other, in blocks of bounded size.

A crowded group is cut into blocks by a hash, and each pair of blocks is one
piece of work.  Pieces come sorted to a task, which holds one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.tables import written


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of the group they belong to (by ``keys``, none of them NULL); rows without a group go.

    ``groups`` has one row for each group and says in ``rows`` how many rows it has.  Groups with more than half of
    what falls to a task are no more than twice as many as tasks, so they are broadcast, and their rows stay where
    they are; only rows of the other groups are dealt out by key.
    """
    spark = rows.sparkSession
    groups = written(groups, "groups")
    share = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = groups.agg(F.sum("rows")).first()[0] or 0
    crowded = F.col("rows") * share > total
    large = F.broadcast(groups.filter(crowded).drop("rows"))
    small = groups.filter(~crowded).drop("rows")
    marked = rows.join(large.select(*keys, F.lit(True).alias("crowded")), keys, "left")
    few = marked.filter("crowded is null").drop("crowded").join(small, keys)
    return rows.join(large, keys).unionByName(few)


def block_pairs(
    members: DataFrame, keys: list[str], payload: DataFrame, block_rows: int = 1024, block_weight: int = 1_000_000
) -> DataFrame:
    """The members (``keys``, ``id``, ``weight``) of groups of two and more with the columns of their
    ``payload`` (by ``id``): once for each pair ``i``, ``j`` of blocks they take part in, ``own`` being theirs."""
    crowds = members.groupBy(*keys).agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.ceil(F.sum("weight") / block_weight)).cast("int").alias("blocks"),
        F.count(F.lit(1)).alias("rows"),
    )
    own = (
        join_groups(members.drop("weight"), crowds.filter("rows > 1"), keys)
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other", "blocks")
    )
    piece = [*keys, "i", "j"]
    return own.join(payload, "id").repartition(*piece).sortWithinPartitions(*piece)


def pieces(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """The rows of each piece of at least two rows, from sorted batches."""
    piece, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[k] for k in keys) + (row["i"], row["j"])
            if own != key:
                if len(piece) > 1:
                    yield piece
                piece, key = [], own
            piece.append(row)
    if len(piece) > 1:
        yield piece


def sides(piece: list[dict]) -> tuple[np.ndarray, np.ndarray, bool]:
    """The places of the rows of one block and of the other, and whether they are the same block."""
    if piece[0]["i"] == piece[0]["j"]:
        return np.arange(len(piece)), np.arange(len(piece)), True
    own = np.array([row["own"] for row in piece])
    return np.flatnonzero(own == piece[0]["i"]), np.flatnonzero(own == piece[0]["j"]), False


def local_roots(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row the smallest id that the pairs of rows ``a``, ``b`` reach."""
    root = ids.copy()
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        if (root == before).all():
            return root
