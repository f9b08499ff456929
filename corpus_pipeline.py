"""From raw documents to token ids in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of documents.  Languages are learned from all rows that
have one and are not held out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.llm.byte_pairs import read_ranks, token_digests
from clicktally.llm.languages import UNKNOWN, with_languages
from clicktally.llm.line_runs import without_repeated_lines
from clicktally.llm.mixing import mixed
from clicktally.llm.near_duplicates import near_duplicates
from clicktally.llm.tables import is_held_out, written, written_to
from clicktally.sources.scratch import remove_folder, scratch_path, scratch_scope

RANKS = "byte_bpe_multi_50k.tiktoken"


def _row(docs: DataFrame, **changed):
    """The columns of ``docs`` out of the struct ``row``, some with new values."""
    return [changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The largest language of the mixture becomes ``lang``; NULL texts and texts without a letter go.

    Where no row could be learned from, ``lang`` stays as it is.
    """
    found = with_languages(docs, ~is_held_out() & F.col("doc_id").isNotNull())
    own = F.when(F.col("language.lang") != UNKNOWN, F.col("language.lang")).otherwise(F.col("row.lang"))
    return found.filter("language.has_letters").select(*_row(docs, lang=own))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 20 code points in at least 3 documents stay in the largest document only."""
    changed = {"text": F.col("lines.text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("lines.text").cast(docs.schema["n_chars"].dataType)
    return without_repeated_lines(docs).select(*_row(docs, **changed))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 0.8 of their five-word shingles the smallest stays.

    Rows get keys of their own in the order of their numbers, so copies that
    have no number or the same one are documents like any other.
    """
    packed = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("seq"))
    order = [F.col("row.doc_id").asc_nulls_last(), F.col("seq")]
    keyed = written(
        packed.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("row", F.col("row.text").alias("text"), F.monotonically_increasing_id().alias("row_key")),
        "keyed-rows",
    )
    found = near_duplicates(keyed.select("row_key", "text"), shingle_words=5, percent=80, id_col="row_key")
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("row_key")).distinct()
    return keyed.join(gone, "row_key", "left_anti").select(*_row(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, sources weighing the square root of their size, in shuffled order."""
    return mixed(docs).select(*_row(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the bytes they decode to, as digests."""
    return token_digests(docs, read_ranks(public_tokenizers.path(RANKS)))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("byte_level_bpe", encode),
]

#: SQL expresses neither mixtures, components nor byte pairs; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    What a stage has put into the shared folder goes when its own result is written there, and that when the next
    stage's is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark):
            docs = written_to(stage(spark, docs, sf_dir), path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
