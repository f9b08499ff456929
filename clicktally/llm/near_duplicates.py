"""Near-duplicate documents by circulant MinHash.

A signature needs two permutations only: the first scatters the shingles over
the universe of 32-bit numbers, the second gives their order, and coordinate k
of the signature is the minimum after a shift of the universe by k.

Copies with the same shingle set form a class, whose smallest document stands
for it.  Representatives that share a band of their signatures are candidates:

1. In the buckets of the first bands every member is compared with one of them,
   drawn by a hash.  The links found join most of each group.
2. Then, over all bands, members of a bucket that are still in different
   components are compared, each with each.  Crowded buckets are cut into
   blocks, and only a tree over the links found leaves a block.  Members of the
   same component need no comparison.  No link between components is lost.

Every candidate is confirmed on the full shingle sets.

Defined results: a document without words (NULL or blank text) is linked with
nothing.  Rows that share a document number are one document, linked where any
of them is.  A row without a number is compared with nothing and kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.blocks import block_pairs, local_roots, pieces, sides
from clicktally.llm.components import components
from clicktally.llm.shingles import shingle_hashes, texts_with_words
from clicktally.llm.tables import identified_texts, written

#: At similarity 0.8 a pair shares no band with probability (1 - 0.8^5)^32 = 3e-6, and at 0.9 none of
#: the first eight with (1 - 0.9^5)^8 = 8e-4; what the first bands miss is left to the rest.
BANDS, ROWS, FIRST_BANDS = 32, 5, 8

_SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>"


def permuted(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    t = x >> np.uint32(16)
    x ^= t
    x *= np.uint32(a)
    np.right_shift(x, np.uint32(15), out=t)
    x ^= t
    x *= np.uint32(b)
    np.right_shift(x, np.uint32(16), out=t)
    x ^= t
    return x


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` MinHash coordinates of a set of 64-bit shingle hashes; the set has a member at least."""
    place = permuted((shingles >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    shift = np.arange(size, dtype=np.uint32)
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(place), 1024):
        shifted = place[at : at + 1024, None] - shift
        np.minimum(least, permuted(shifted, 0x21F0AAAD, 0xD35A2D97).min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    rows = np.ascontiguousarray(coordinates.reshape(bands, -1)).astype(np.uint64)
    keys = shingle_hashes(np.arange(bands, dtype=np.uint64), 1)
    with np.errstate(over="ignore"):
        for column in rows.T:
            keys = shingle_hashes(keys + column + np.uint64(1), 1)
    return keys.view(np.int64)


def _sign(size: int, bands: int, rows: int) -> Callable:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, words in texts_with_words([batch]):
                own = np.unique(shingle_hashes(words, size))
                if len(own):
                    keys = band_keys(signature(own, bands * rows), bands)
                    out.append((doc_id, len(own), hashlib.md5(own.tobytes()).digest(), keys))
                else:
                    out.append((doc_id, 0, None, None))
            ids, counts, digests, keys = zip(*out, strict=True) if out else ([], [], [], [])
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return sign


def _shingle_sets(size: int) -> Callable:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(key, np.unique(shingle_hashes(words, size)).tobytes()) for key, words in texts_with_words([batch])]
            yield pa.record_batch(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())],
                names=["doc_id", "shingles"],
            )

    return sets


def _similar(percent: int) -> Callable:
    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return similar


def _sets_of(ids: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``shingles`` (sorted hashes) of the documents with these numbers."""
    wanted = written(ids, "candidates")
    return written(
        texts.join(wanted, "doc_id", "left_semi").mapInArrow(_shingle_sets(size), "doc_id long, shingles binary"),
        "shingles",
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full shingle sets are as similar as asked."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), texts, size)
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b"
    )
    return written(both.select("a", "b", "x", "y").mapInArrow(_similar(percent), "a long, b long"), "confirmed")


def _star_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket with one of the bucket, another one in each band."""
    drawn = F.min(F.struct(F.xxhash64("id", "band"), "id"))
    centres = members.groupBy("band", "key").agg(drawn["id"].alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = members.join(centres, ["band", "key"]).filter("id != centre")
    return met.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()


def _unsettled(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Members (with their component as ``part``) of buckets that hold more than one component."""
    placed = members.join(joined.withColumnRenamed("node", "id"), "id", "left").select(
        "band", "key", "id", "weight", F.coalesce("component_id", "id").alias("part")
    )
    parts = placed.groupBy("band", "key").agg(F.min("part").alias("first"), F.max("part").alias("last"))
    return placed.join(parts.filter("first != last").select("band", "key"), ["band", "key"])


def _crossing(percent: int) -> Callable:
    """A tree over the links between components in each pair of blocks of a bucket."""

    def links(piece: list[dict]) -> list[tuple[int, int]]:
        band, (x, y, same) = piece[0]["band"], sides(piece)
        ids, parts = (np.array([row[c] for row in piece]) for c in ("id", "part"))
        bands = np.array([row["bands"] for row in piece])
        sets = [np.frombuffer(row["shingles"], np.uint64) for row in piece]
        sizes = np.array([len(own) for own in sets])
        firsts, seconds = [], []
        # Members of the commonest component are never compared with each other, so the others go through.
        commonest = np.bincount(np.unique(parts, return_inverse=True)[1]).argmax()
        common = parts == np.unique(parts)[commonest]
        for left, right, both in ((x, y, same), (y, x, True)):
            for k in left[~common[left]].tolist():
                other = right[(parts[right] != parts[k])]
                if both:  # each pair once
                    other = other[common[other] | (other < k)] if same else other[common[other]]
                other = other[~(bands[other, :band] == bands[k, :band]).any(axis=1)]
                least, most = np.minimum(sizes[other], sizes[k]), np.maximum(sizes[other], sizes[k])
                other = other[100 * least >= percent * most]
                if not len(other):
                    continue
                flat = np.concatenate([sets[o] for o in other.tolist()])
                at = np.minimum(np.searchsorted(sets[k], flat), sizes[k] - 1)
                shared = np.add.reduceat(sets[k][at] == flat, np.cumsum(sizes[other]) - sizes[other])
                linked = other[100 * shared >= percent * (sizes[other] + sizes[k] - shared)]
                firsts.append(np.full(len(linked), k))
                seconds.append(linked)
            if same:
                break
        if not firsts:
            return []
        root = local_roots(ids, np.concatenate(firsts), np.concatenate(seconds))
        return [(int(r), int(i)) for r, i in zip(root, ids, strict=True) if r != i]

    def crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ["band", "key"]):
            a, b = zip(*found, strict=True) if (found := links(piece)) else ([], [])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return crossing


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    first_bands: int = FIRST_BANDS,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: one row per row of ``docs``.

    Two documents are linked if the intersection of their shingle sets has at
    least ``percent`` hundredths of the size of the union; a component is what
    links reach, named after and kept as its smallest document.
    """
    texts = identified_texts(docs, id_col, text_col)
    signed = written(texts.mapInArrow(_sign(shingle_words, bands, rows), _SIGNED), "signed")
    named = signed.filter("digest is not null and doc_id is not null")
    classes = written(named.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    standing = written(
        named.join(classes.select(F.col("id").alias("doc_id"), F.col("digest").alias("d")), "doc_id")
        .filter("digest = d")
        .select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("weight"), "bands"),
        "representatives",
    )
    members = standing.select("id", "weight", F.posexplode("bands").alias("band", "key"))
    stars = written(_star_pairs(members.filter(F.col("band") < first_bands)), "stars")
    first = _confirmed(stars, texts, shingle_words, percent)
    copies = named.join(classes, "digest").filter("doc_id != id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    joined = components(first.union(copies))
    unsettled = written(_unsettled(members, joined), "unsettled")
    sets = _sets_of(unsettled.select(F.col("id").alias("doc_id")).distinct(), texts, shingle_words)
    payload = standing.select("id", "bands").join(sets.withColumnRenamed("doc_id", "id"), "id")
    second = written(
        block_pairs(unsettled, ["band", "key"], payload, block_rows=2048).mapInArrow(_crossing(percent), "a long, b long"), "crossing"
    )
    final = components(joined.select(F.col("component_id").alias("a"), F.col("node").alias("b")).union(second))
    return signed.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )
