"""Tables written between two steps, and the columns operators read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.sources.scratch import scratch_path


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The rows of ``df``, kept in the shared folder, so that a lost executor costs no earlier step."""
    return written_to(df, scratch_path(df.sparkSession, name), *partition_by)


def written_to(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def identified_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` long and ``text`` string, NULL texts as empty ones; every other column is left out."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def is_held_out(id_col: str = "doc_id") -> Column:
    """Whether a row stays out of training: crc32 of its number as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
