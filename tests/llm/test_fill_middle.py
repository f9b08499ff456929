"""Texts with their middle moved: against plain Python, for each unit, and rank queries against counting."""

import hashlib
import random
import re

import numpy as np
import pytest
from clicktally.llm.fill_middle import cuts, fill_in_middle, restored
from clicktally.llm.wavelets import WaveletMatrix
from pyspark.sql import functions as F

SIGNS = ["<P>", "<S>", "<M>"]


def starts_of(text, unit):
    """Code points at which a unit begins."""
    if unit == "code point":
        return list(range(len(text)))
    if unit == "line":
        return [0, *[m.end() for m in re.finditer("\n", text) if m.end() < len(text)]] if text else []
    return [m.start() for m in re.finditer("[^\x20\x09-\x0d]+", text)]


def plain(doc_id, text, unit="code point"):
    text = text or ""
    starts = starts_of(text, unit)
    n = len(starts)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(s in text for s in SIGNS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, q = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    at = [0 if k == 0 else len(text) if k == n else starts[k] for k in (p, q)]
    prefix, middle, suffix = text[: at[0]], text[at[0] : at[1]], text[at[1] :]
    if h[3] % 100 < 20:
        return n, "spm", p, q - p, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", p, q - p, f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rng = random.Random(5)
    made = ["".join(rng.choices("ab é中\U0001f600\n\t\x0b  .<>PSM̈", k=rng.randint(0, 60))) for _ in range(250)]
    return made + ["", None, "x", "\n", " \n ", "中", "a<P>b", "<S", "<" * 40, "P>" * 30, "word " * 40_000, "\U0001f600" * 30_000]


@pytest.mark.parametrize("unit", ["code point", "word", "line"])
@pytest.mark.parametrize("block", [4_000_000, 50])
def test_against_plain_python(spark, documents, unit, block):
    rows = [(i, text, "en", "s") for i, text in enumerate(texts())]
    rows += [(None, "no number", "en", "s"), (3, "one number", "en", "s"), (3, "one number", "en", "s"), (-4, "below", "en", "s")]
    docs = documents(rows).withColumn("fim", F.lit("own")).withColumn("cut", F.lit("own")).withColumn("h1", F.lit("own"))
    found = fill_in_middle(docs, unit=unit, block_bytes=block).withColumn("again", restored(F.col("fim.output"), F.col("fim.form")))
    assert found.count() == len(rows)
    for r in found.collect():
        assert tuple(r.fim) == plain(r.row.doc_id, r.row.text, unit)
        assert r.again == (r.row.text or "")
        assert (r.row.fim, r.row.cut, r.row.component_id) == ("own", "own", "own")
    forms = {r.form for r in found.select("fim.form").collect()}
    assert forms == {"plain", "psm", "spm"}


def test_no_texts(spark, documents):
    assert fill_in_middle(documents([])).count() == 0


def test_cuts_inside_one_block_and_many():
    rng = np.random.default_rng(0)
    many = [t.encode() for t in (x or "" for x in texts())]
    draws = rng.integers(0, 2**32, (len(many), 2))
    together = cuts(many, draws, "word")
    alone = np.concatenate([cuts([t], draws[i : i + 1], "word") for i, t in enumerate(many)])
    assert (together == alone).all()


def test_ranks_are_counts():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 5, size).astype(np.uint8)
        matrix = WaveletMatrix(symbols, 3)
        places = np.arange(size + 1)
        for s in range(8):
            assert matrix.rank(s, places).tolist() == np.append(0, np.cumsum(symbols == s)).tolist()
        low, high = np.zeros(size, np.int64), np.full(size, size)
        at = matrix.find((1, 4), np.arange(1, size + 1), low, high)
        wanted = np.flatnonzero((symbols == 1) | (symbols == 4))
        assert at[: len(wanted)].tolist() == wanted.tolist() and (at[len(wanted) :] == size).all()
