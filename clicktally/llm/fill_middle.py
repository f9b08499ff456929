"""Texts with their middle moved to the end, cut at ranks of a wavelet matrix.

The bytes of a text fall into classes: bytes inside a code point, and first
bytes of a code point, told apart by whether a word, a line or both begin there.
A wavelet matrix over these classes answers how many bytes of a class come
before a place.  Ranks of several classes added up count the boundaries of
units (code points, words or lines), and halving on that count finds the byte at
which a unit begins, so both cuts of a text are found without decoding it.

The texts of a batch share matrices, about ``BLOCK_BYTES`` each, and their cuts
are sought together.  Python hands back five numbers a text; the pieces are put
together by Spark.

Defined results: a NULL text is empty.  A row without a number is drawn as if
its number were empty text, and rows of one number are drawn alike.  A text that
is empty or holds one of the signs stays plain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.llm.codepoints import batched
from clicktally.llm.wavelets import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
BLOCK_BYTES = 4_000_000

INSIDE, CODE_POINT, WORD, LINE, LINE_AND_WORD = range(5)
#: The classes of bytes at which a unit begins.
UNITS = {
    "code point": (CODE_POINT, WORD, LINE, LINE_AND_WORD),
    "word": (WORD, LINE_AND_WORD),
    "line": (LINE, LINE_AND_WORD),
}


def byte_classes(chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each byte of texts that begin at ``starts``; words are ``[^\\x20\\x09-\\x0D]+``, lines end with \\n."""
    if not len(chars):
        return np.zeros(0, np.uint8)
    begins = np.zeros(len(chars), bool)
    begins[starts[starts < len(chars)]] = True
    gap = (chars == 0x20) | ((chars >= 9) & (chars <= 13))
    word = ~gap & (begins | np.append(True, gap[:-1]))
    line = begins | np.append(True, chars[:-1] == 0x0A)
    first = (chars & 0xC0) != 0x80
    return (first * (CODE_POINT + word + 2 * line)).astype(np.uint8)


def cuts(texts: list[bytes], draws: np.ndarray, unit: str) -> np.ndarray:
    """For each text the number of units n, then the smaller and the larger of its two ``draws`` modulo n + 1,
    and the bytes before those two cuts."""
    symbols = UNITS[unit]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    matrix = WaveletMatrix(byte_classes(np.frombuffer(b"".join(texts), np.uint8), starts), bits=3)
    before = matrix.count(symbols, starts)
    n = matrix.count(symbols, ends) - before
    parts = np.sort(draws % (n + 1)[:, None], axis=1)
    out = [n, *parts.T]
    for part in parts.T:
        place = matrix.find(symbols, before + part + 1, starts, ends)
        out.append(np.where(part == 0, starts, np.where(part == n, ends, place)) - starts)
    return np.stack(out, axis=1)


_CUTS = "n long, first long, second long, first_byte long, second_byte long"


def _cuts_udf(unit: str, block_bytes: int):
    names = [field.split()[0] for field in _CUTS.split(", ")]

    @F.arrow_udf(_CUTS)
    def found(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, a, b in parts:
            draws = np.stack([x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b)], axis=1)
            blocks, at = [np.zeros((0, len(names)), np.int64)], 0
            for block in batched(text.to_pylist(), len, block_bytes):
                blocks.append(cuts(block, draws[at : at + len(block)], unit))
                at += len(block)
            yield pa.StructArray.from_arrays([pa.array(c) for c in np.concatenate(blocks).T], names)

    return found


def _draw(id_text: Column, seed: int, k: int) -> Column:
    """The k-th group of eight digits of the hex sha256 of seed and number, as a whole number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_text), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    part = lambda text, sign, k: F.split_part(text, F.lit(sign), F.lit(k))
    after = lambda sign: part(output, sign, 2)
    psm = F.concat(part(after(PREFIX), SUFFIX, 1), after(MIDDLE), part(after(SUFFIX), MIDDLE, 1))
    spm = F.concat(part(after(PREFIX), MIDDLE, 1), after(MIDDLE), part(after(SUFFIX), PREFIX, 1))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def fill_in_middle(
    docs: DataFrame,
    unit: str = "code point",
    seed: int = 1,
    moved_percent: int = 90,
    suffix_first_percent: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row`` (the whole row of ``docs``) and ``fim``: struct of ``n`` (units of the text), ``form`` (plain, psm
    or spm), ``prefix``, ``middle`` (units of each, NULL where plain) and ``output``."""
    packed = docs.select(F.struct("*").alias("row"))
    id_text = F.coalesce(F.col("row")[id_col].cast("string"), F.lit(""))
    drawn = packed.select(
        "row",
        F.coalesce(F.col("row")[text_col], F.lit("")).alias("text"),
        *[_draw(id_text, seed, k).alias(f"h{k + 1}") for k in range(4)],
    )
    body = F.col("text").cast("binary")
    found = drawn.withColumn("cut", _cuts_udf(unit, block_bytes)(body, "h1", "h2"))
    plain = (F.col("text") == "") | (F.col("h3") % 100 >= moved_percent)
    for sign in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(F.col("text"), F.lit(sign))
    form = F.when(plain, PLAIN).when(F.col("h4") % 100 < suffix_first_percent, SPM).otherwise(PSM)
    formed = found.withColumn("form", form)

    def stretch(start: Column, end: Column) -> Column:
        return F.substring(body, (start + 1).cast("int"), (end - start).cast("int")).cast("string")

    first, second = F.col("cut.first_byte"), F.col("cut.second_byte")
    prefix, middle = stretch(F.lit(0), first), stretch(first, second)
    suffix = stretch(second, F.octet_length(body).cast("long"))
    output = (
        F.when(F.col("form") == PSM, F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == SPM, F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.col("text"))
    )
    moved = F.col("form") != PLAIN
    return formed.select(
        "row",
        F.struct(
            F.col("cut.n").alias("n"),
            "form",
            F.when(moved, F.col("cut.first")).alias("prefix"),
            F.when(moved, F.col("cut.second") - F.col("cut.first")).alias("middle"),
            output.alias("output"),
        ).alias("fim"),
    )
