"""A quality classifier on learned subword vectors.

A document is a bag of hashed words, ordered pairs of words and character
trigrams.  The words are normalised first: one that repeats the word before it
becomes a sign of repetition, as a repeated rare word is in no training text.
Each bucket has a learned vector, the document is their mean, and a softmax
layer turns that into two probabilities.  Vectors and layer are trained by stochastic gradient
descent in numpy on a bounded sample of labelled documents.  As the layer is
linear, scoring needs one number for each bucket: the difference of the two
outputs its vector alone would give.

Defined results: NULL and empty texts have no buckets and get the score of the
layer's offsets, the share of label 1 as trained.  Without labelled rows every
score is 0.5.  Rows with NULL labels are not learned from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.llm.codepoints import batched, mixed, points, span_hashes
from clicktally.llm.shingles import _is_gap
from clicktally.llm.tables import written

#: At most so many labelled documents are learned from, those with the smallest hashes of their numbers, and of these
#: as many as have so many bytes of buckets together, which the driver holds.
MAX_LABELLED, MAX_BAG_BYTES = 6000, 256_000_000
BITS = 16
KINDS = 3
_BLOCK_CHARS = 500_000
#: Stands for a word that repeats the one before it.
_AGAIN = np.uint64(1)


def buckets(texts: list[str], bits: int = BITS) -> list[np.ndarray]:
    """For each text the buckets of its words, of its ordered pairs of neighbouring words and of its character
    trigrams; a word that repeats the one before is read as a sign of repetition, whatever the word."""
    sizes = np.array([len(t) + 1 for t in texts])
    chars = points("\n".join(texts) + "\n")
    ends = np.cumsum(sizes)
    gap = _is_gap(chars)
    opens = np.flatnonzero(np.append(True, gap[1:] != gap[:-1]))
    word = ~gap[opens]
    words, at = span_hashes(chars, opens)[word], opens[word]
    owner = np.searchsorted(ends, at, side="right")
    pair = owner[1:] == owner[:-1]
    again = np.append(False, (words[1:] == words[:-1]) & pair)
    words = np.where(again, _AGAIN, words)
    couples = mixed(mixed(words[:-1]) + words[1:])[pair]
    key = (chars[:-2].astype(np.uint64) << np.uint64(42)) | (chars[1:-1].astype(np.uint64) << np.uint64(21)) | chars[2:]
    inside = np.repeat(ends, sizes)[: len(key)] - 1 >= np.arange(len(key)) + 3
    places = [at, at[:-1][pair], np.flatnonzero(inside)]
    hashes = [words, couples, mixed(key[inside])]
    found = [(h >> np.uint64(64 - bits)).astype(np.int32) + np.int32(k << bits) for k, h in enumerate(hashes)]
    parts = [np.split(f, np.searchsorted(p, ends[:-1])) for p, f in zip(places, found, strict=True)]
    return [np.concatenate(own) for own in zip(*parts, strict=True)]


def bag(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, counts = np.unique(found, return_counts=True)
    return own.astype(np.int32), (counts / max(len(found), 1)).astype(np.float32)


@dataclass
class SubwordModel:
    """Vectors of all buckets, and the layer from a mean vector to the two outputs."""

    vectors: np.ndarray
    layer: np.ndarray
    offsets: np.ndarray

    def margins(self) -> tuple[np.ndarray, float]:
        """For each bucket, and for every document, what speaks for label 1 more than for label 0."""
        each = self.vectors @ (self.layer[:, 1] - self.layer[:, 0])
        return each.astype(np.float32), float(self.offsets[1] - self.offsets[0])


def train(
    bags: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    size: int = 8,
    epochs: int = 6,
    rate: float = 20.0,
    seed: int = 0,
    bits: int = BITS,
) -> SubwordModel:
    """One step for each document in shuffled order; the rate falls to nothing in a straight line."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (KINDS << bits, size)).astype(np.float32)
    layer = rng.uniform(-1 / size, 1 / size, (size, 2)).astype(np.float32)
    offsets = np.log(np.maximum(np.bincount(labels, minlength=2), 0.5) / max(len(labels), 1)).astype(np.float32)
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for d in rng.permutation(len(bags)).tolist():
            own, weight = bags[d]
            pace = rate * (1 - done / steps)
            done += 1
            rows = vectors[own]
            mean = weight @ rows
            out = mean @ layer + offsets
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[labels[d]] -= 1
            # Weights of a bag add up to one: scaled by the bag's size, one step moves all vectors alike.
            vectors[own] = rows - (pace * weight)[:, None] * (layer @ error)
            layer -= 0.05 * pace / rate * np.outer(mean, error) * 10
            offsets -= 0.01 * pace / rate * error
    return SubwordModel(vectors, layer, offsets)


def _bags(bits: int) -> Callable:
    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "label", "draw")), strict=True)
            for block in batched(rows, lambda row: len(row[0]), _BLOCK_CHARS):
                own = [bag(found) for found in buckets([row[0] for row in block], bits)]
                yield pa.record_batch(
                    [pa.array([b.tobytes() for b, _ in own], pa.binary()),
                     pa.array([w.tobytes() for _, w in own], pa.binary()),
                     pa.array([row[1] for row in block], pa.int32()),
                     pa.array([row[2] for row in block], pa.int64())],
                    names=["buckets", "weights", "label", "draw"],
                )

    return bags


def learn_quality(
    docs: DataFrame, labels: DataFrame, training: Column, label_col: str = "quality",
    id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, bits: int = BITS,
    max_bag_bytes: int = MAX_BAG_BYTES,
) -> SubwordModel | None:
    """A model from at most ``max_labelled`` labelled rows that ``training`` holds for; None without any."""
    sample = (
        labels.filter(training & F.col(label_col).isin(0, 1))
        .select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(max_labelled)
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = written(
        texts.join(sample, "doc_id")
        .select("doc_id", "text", "label")
        .repartition("doc_id")
        .select("text", "label", F.xxhash64("doc_id").alias("draw"))
        .mapInArrow(_bags(bits), "buckets binary, weights binary, label int, draw long"),
        "bags",
    )
    size = F.sum(F.octet_length("buckets") + F.octet_length("weights")).alias("size")
    sizes = sorted(tuple(r) for r in found.groupBy("draw").agg(size).collect())
    if not sizes:
        return None
    held = np.cumsum([size for _, size in sizes])
    last = max(int(np.searchsorted(held, max_bag_bytes, side="right")) - 1, 0)
    rows = found.filter(F.col("draw") <= sizes[last][0]).collect()
    rows.sort(key=lambda r: (r.buckets, r.label))
    bags = [(np.frombuffer(r.buckets, np.int32), np.frombuffer(r.weights, np.float32)) for r in rows]
    return train(bags, np.array([r.label for r in rows]), bits=bits)


def quality_udf(model: SubwordModel | None, spark, bits: int = BITS) -> Callable:
    """A function of a text column: the probability of label 1."""
    sent = spark.sparkContext.broadcast(model.margins() if model else (np.zeros(KINDS << bits), 0.0))

    @F.pandas_udf("double")
    def quality(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        each, offset = sent.value
        for texts in parts:
            out = []
            for block in batched(((t or "",) for t in texts), lambda row: len(row[0]), _BLOCK_CHARS):
                for found in buckets([row[0] for row in block], bits):
                    margin = offset + (float(each[found].mean()) if len(found) else 0.0)
                    out.append(1 / (1 + np.exp(-margin)))
            yield pd.Series(out, dtype="float64")

    return quality
