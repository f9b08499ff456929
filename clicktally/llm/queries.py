"""The operators as registered queries over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.llm.licences import NOTICES
from clicktally.llm.oracles import FILL_IN_MIDDLE, LINE_DEDUP, SOURCE_MIX, licence_scan

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_pair_encoding(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from clicktally.llm.byte_pairs import read_ranks, token_digests

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return token_digests(_table(spark, folder, "documents"), ranks)


def language_mixtures(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.languages import with_languages
    from clicktally.llm.tables import is_held_out

    found = with_languages(_table(spark, folder, "documents"), ~is_held_out() & F.col("doc_id").isNotNull())
    return found.select(
        "row.doc_id",
        is_held_out("row.doc_id").alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        "language.score",
        "language.n_languages",
    )


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.quality import learn_quality, quality_udf
    from clicktally.llm.tables import is_held_out

    docs = _table(spark, folder, "documents")
    training = ~is_held_out() & F.col("doc_id").isNotNull()
    model = learn_quality(docs, _table(spark, folder, "labels"), training)
    scored = docs.select("doc_id", is_held_out().alias("held_out"), quality_udf(model, spark)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.line_runs import without_repeated_lines

    return without_repeated_lines(_table(spark, folder, "documents")).select(
        "row.doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.text", 256).alias("kept_sha256")
    )


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.mixing import mixed

    return mixed(_table(spark, folder, "documents")).select("row.doc_id", "row.source", "copy", "place", "row.text")


def near_duplicate_documents(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.near_duplicates import near_duplicates

    return near_duplicates(_table(spark, folder, "documents"), shingle_words=2, percent=80)


def near_duplicate_vectors(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.near_vectors import near_vectors

    return near_vectors(_table(spark, folder, "embeddings"))


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.forest import nearest

    return nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def licence_scan_matches(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.licences import licence_matches

    return licence_matches(_table(spark, folder, "documents"))


def shared_passages(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.passages import repeated_passages

    return repeated_passages(_table(spark, folder, "documents"))


def whitened_vectors(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.whitening import whitened

    return whitened(_table(spark, folder, "embeddings"))


def middles_moved(spark: SparkSession, folder: str) -> DataFrame:
    from clicktally.llm.fill_middle import fill_in_middle, restored

    return fill_in_middle(_table(spark, folder, "documents").select("doc_id", "text")).select(
        "row.doc_id",
        "fim.n",
        "fim.form",
        F.col("fim.prefix").alias("prefix_chars"),
        F.col("fim.middle").alias("middle_chars"),
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )


def packed_documents(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from clicktally.llm.packing import packed_pieces

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        pieces = packed_pieces(_table(spark, folder, "documents"), file.read())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Query]:
    return {
        "op1_licence_scan": licence_scan_matches,
        "op2_paragraph_minhash": shared_passages,
        "op3_language_mixture": language_mixtures,
        "op4_collision_counting": near_duplicate_vectors,
        "op5_subword_quality": quality_scores,
        "op6_line_runs": line_dedup,
        "op7_poisson_mix": source_mix,
        "op8_byte_level_bpe": byte_pair_encoding,
        "op9_projection_forest": nearest_vectors,
        "op10_circulant_minhash": near_duplicate_documents,
        "op11_block_whitening": whitened_vectors,
        "op12_wavelet_fill_in_middle": middles_moved,
        "op13_best_fit_packing": packed_documents,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for those queries that SQL can express."""
    return {
        "op1_licence_scan": licence_scan(NOTICES),
        "op6_line_runs": LINE_DEDUP,
        "op7_poisson_mix": SOURCE_MIX,
        "op12_wavelet_fill_in_middle": FILL_IN_MIDDLE,
    }
