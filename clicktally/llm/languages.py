"""Languages of documents as mixtures, by expectation maximisation.

Each language is a distribution of letter trigrams, counted over all training
documents.  A document is taken as a mixture of languages: expectation
maximisation estimates the proportions from the likelihoods of its trigrams.
The languages are then ranked by proportion, and of the sets of the first one,
two, three ... languages the one is chosen whose likelihood, less half the
logarithm of the number of trigrams for each further language, is largest;
from three languages on, the set grows as long as that still rises.
The answer is the chosen set with its proportions, the largest first.

Defined results: a NULL text or one without a letter is ``und`` with score 0.
Without training rows every document is ``und``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.llm.codepoints import LETTER, batched, kinds, mixed, points

UNKNOWN = "und"
BUCKET_BITS = 15
_BLOCK_CHARS = 250_000
_EM_BLOCK = 200_000


@cache
def _letters() -> np.ndarray:
    """Each code point as a small letter, and every non-letter as a blank."""
    table = np.full(0x110000, 0x20, np.uint32)
    for i in np.flatnonzero(kinds() == LETTER).tolist():
        table[i] = ord(low) if len(low := chr(i).lower()) == 1 else i
    return table


def trigrams(texts: list[str], bits: int = BUCKET_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and counts of the trigrams of each text that have a letter in the middle or at the end."""
    sizes = np.array([len(t) for t in texts])
    chars = _letters()[points("  " + "  ".join(texts) + "  ")].astype(np.uint64)
    blank = chars == 0x20
    # The three code points, 21 bits each, in one number.
    hashed = mixed((chars[:-2] << np.uint64(42)) | (chars[1:-1] << np.uint64(21)) | chars[2:]) >> np.uint64(64 - bits)
    counted = ~(blank[1:-1] & (blank[2:] | blank[:-2]))
    out, at = [], 0
    for size in sizes.tolist():
        window = slice(at, at + size + 2)
        found = np.bincount(hashed[window][counted[window]].astype(np.int64), minlength=1 << bits)
        buckets = np.flatnonzero(found)
        out.append((buckets, found[buckets]))
        at += size + 2
    return out


def _count(bits: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            rows = zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for block in batched(rows, lambda row: len(row[1]), _BLOCK_CHARS):
                for (lang, _), (buckets, counts) in zip(block, trigrams([x[1] for x in block], bits), strict=True):
                    sums.setdefault(lang, np.zeros(1 << bits, np.int64))[buckets] += counts
        for lang, total in sums.items():
            buckets = np.flatnonzero(total)
            yield pa.record_batch(
                [pa.array([lang] * len(buckets), pa.string()), pa.array(buckets, pa.int32()), pa.array(total[buckets])],
                names=["lang", "bucket", "n"],
            )

    return count


def learn_languages(
    docs: DataFrame,
    training: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    bits: int = BUCKET_BITS,
    max_languages: int = 1000,
) -> tuple[list[str], np.ndarray]:
    """The languages and their log likelihoods of the trigram buckets, one row per language.

    All rows that ``training`` holds for are counted.  What comes to the
    driver has a fixed size for each language, and there may be no more than
    ``max_languages``, which is tested before any text is read.
    """
    labelled = docs.filter(training & F.col(lang_col).isNotNull())
    if len(labelled.select(lang_col).distinct().limit(max_languages + 1).collect()) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    rows = labelled.filter(F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    found = (
        rows.mapInArrow(_count(bits), "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
        .orderBy("lang")
        .toArrow()  # packed numbers, no objects
    )
    table = np.full((len(found), 1 << bits), 0.5)
    for k, batch in enumerate(found.column("counts")):
        own = batch.values
        table[k, own.field("bucket").to_numpy()] += own.field("n").to_numpy()
    table = np.log(table / table.sum(axis=1, keepdims=True)) if len(found) else table
    return found.column("lang").to_pylist(), table.astype(np.float32)


def _proportions(
    likely: np.ndarray, counts: np.ndarray, starts: np.ndarray, shares: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each document after some rounds, and the log likelihood before the last.

    ``likely``: a row of likelihoods for each trigram; ``starts``: where the
    trigrams of each document begin; ``shares``: first proportions.
    """
    sizes = np.diff(np.append(starts, len(counts)))
    total = np.add.reduceat(counts, starts)[:, None]
    fit = None
    for _ in range(rounds):
        each = likely * np.repeat(shares, sizes, axis=0)
        whole = each.sum(axis=1)
        fit = np.add.reduceat(counts * np.log(whole), starts)
        shares = np.add.reduceat(each * (counts / whole)[:, None], starts) / total
    return shares, fit


def mixtures(
    grams: list[tuple[np.ndarray, np.ndarray]], table: np.ndarray, rounds: int = 10, set_rounds: int = 4, least_tried: int = 3
) -> list[list[tuple[int, float]]]:
    """For each document the chosen languages and their proportions, the largest first.

    Sets of up to ``least_tried`` languages are all tried, larger ones while the penalised likelihood rises.
    """
    counts = np.concatenate([c for _, c in grams]).astype(np.float32)
    starts = np.append(0, np.cumsum([len(b) for b, _ in grams]))[:-1]
    sizes = np.array([len(b) for b, _ in grams])
    logs = table[:, np.concatenate([b for b, _ in grams])].T
    peak = logs.max(axis=1, keepdims=True)
    likely = np.exp(logs - peak)  # a factor for each trigram changes no proportion and all likelihoods alike
    n_docs, n_langs = len(grams), len(table)
    shares, _ = _proportions(likely, counts, starts, np.full((n_docs, n_langs), 1 / n_langs, np.float32), rounds)
    order = np.argsort(-shares, axis=1, kind="stable")
    rank = np.argsort(order, axis=1)
    price = 0.5 * np.log(np.maximum(np.add.reduceat(counts, starts), 2))
    best = np.full(n_docs, -np.inf)
    answer: list[list[tuple[int, float]]] = [[]] * n_docs
    rising = np.ones(n_docs, bool)
    for k in range(1, n_langs + 1):
        if k == 1:
            first = np.repeat(order[:, 0], sizes)
            fit = np.add.reduceat(counts * np.log(np.maximum(likely[np.arange(len(counts)), first], 1e-30)), starts)
            own = (rank < 1).astype(np.float32)
        else:
            own = np.where(rank < k, np.maximum(shares, 1e-6), 0).astype(np.float32)
            own, fit = _proportions(likely, counts, starts, own / own.sum(axis=1, keepdims=True), set_rounds)
        score = fit - (k - 1) * price
        better = rising & (score > best)
        for d in np.flatnonzero(better).tolist():
            chosen = order[d, :k]
            chosen = chosen[np.argsort(-own[d, chosen], kind="stable")]
            answer[d] = [(int(x), min(max(float(own[d, x]), 0.0), 1.0)) for x in chosen]
        best = np.where(better, score, best)
        if k >= least_tried:
            rising = better
            if not rising.any():
                break
    return answer


def give_back_memory() -> None:
    """Hand what the last task has freed back to the system: a Python worker waits for others while stages run that
    need the memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def language_udf(languages: list[str], table: np.ndarray, spark, bits: int = BUCKET_BITS) -> Callable:
    """A function of a text column: struct of ``lang``, ``score``, ``n_languages``, ``languages`` and ``shares``
    (of the chosen set, the largest first) and ``has_letters``."""
    sent = spark.sparkContext.broadcast((languages, table))

    @F.pandas_udf(
        "lang string, score double, n_languages int, languages array<string>, shares array<double>, has_letters boolean"
    )
    def language(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, logs = sent.value
        for texts in parts:
            out = []
            for block in batched(((t or "",) for t in texts), lambda row: len(row[0]), _BLOCK_CHARS):
                grams = trigrams([x[0] for x in block], bits)
                answers = [(UNKNOWN, 0.0, 0, [], [], len(buckets) > 0) for buckets, _ in grams]
                known = [k for k, (buckets, _) in enumerate(grams) if len(buckets) and names]
                for some in batched(((k,) for k in known), lambda row: len(grams[row[0]][0]), _EM_BLOCK):
                    ks = [k for (k,) in some]
                    for k, chosen in zip(ks, mixtures([grams[k] for k in ks], logs), strict=True):
                        own, shares = [names[x] for x, _ in chosen], [share for _, share in chosen]
                        answers[k] = (own[0], shares[0], len(own), own, shares, True)
                out += answers
            yield pd.DataFrame(out, columns=["lang", "score", "n_languages", "languages", "shares", "has_letters"])
        texts = out = grams = answers = None
        give_back_memory()

    return language


def with_languages(
    docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``row`` (the whole row of ``docs``) and ``language`` (struct of ``lang``, ``score``, ``n_languages``,
    ``languages``, ``shares``, ``has_letters``).

    Languages are learned from the rows that ``training`` holds for; only texts
    enter a prediction.
    """
    languages, table = learn_languages(docs, training, text_col, lang_col)
    language = language_udf(languages, table, docs.sparkSession)
    packed = docs.select(F.struct("*").alias("row"))
    return packed.select("row", language(F.col("row")[text_col]).alias("language"))
