"""Lines that many documents repeat, found with levelled sorted runs of line hashes.

The line hashes of a batch of documents are merge-joined with the runs kept so
far.  Hashes that no run holds become a new run; of the others a note is kept
how many more documents hold them.  Runs hold different hashes, so to compact
a level is to merge sorted files.  A run is a table bucketed and sorted by
hash: the joins and merges neither deal it out again nor sort it again.

Defined results: a line's key is the line without white space
``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased.  NULL and empty
texts have one empty line.  Rows that share a document number are one
document.  A row without a number is not counted and keeps all its lines.
"""

from __future__ import annotations

import hashlib
import string
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.llm.tables import written
from clicktally.sources.scratch import scratch_path

_WHITE = " \t\n\x0b\x0c\r"
_FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_WHITE)), string.ascii_uppercase, string.ascii_lowercase)


def line_hashes(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``hash`` (md5 of the key), ``doc_id``: each key of at least ``min_chars`` code points once for each document."""
    lines = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.explode(F.split(F.col(text_col), "\n")).alias("line")
    )
    keys = lines.select("doc_id", _key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    return keys.select(F.unhex(F.md5(F.encode("key", "utf-8"))).alias("hash"), "doc_id").distinct()


@dataclass
class LineRuns:
    """Runs of (``hash``, ``n_docs``, ``last_doc``), at most ``fanout`` of them on each level."""

    spark: SparkSession
    fanout: int = 3
    levels: list[list[str]] = field(default_factory=lambda: [[]])
    again: list[DataFrame] = field(default_factory=list)

    def _run(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (
            rows.repartition(parts, "hash")
            .write.bucketBy(parts, "hash")
            .sortBy("hash")
            .option("path", scratch_path(self.spark, name))
            .option("compression", "zstd")
            .saveAsTable(name)
        )
        return name

    def _names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def rows(self) -> DataFrame | None:
        tables = [self.spark.table(name) for name in self._names()]
        whole = tables[0] if tables else None
        for table in tables[1:]:
            whole = whole.union(table)
        return whole

    def add(self, hashes: DataFrame) -> None:
        """Take in the hashes of a batch; no document may be in two batches."""
        own = written(
            hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")), "batch"
        )
        new = own
        for name in self._names():
            run = self.spark.table(name)
            new = new.join(run.hint("merge"), "hash", "left_anti")
            self.again.append(written(own.join(run.select("hash").hint("merge"), "hash", "left_semi"), "again"))
        self.levels[0].append(self._run(new))
        self._compact()

    def _compact(self) -> None:
        for level, names in enumerate(self.levels):
            if len(names) >= self.fanout:
                merged = self.spark.table(names[0])
                for name in names[1:]:
                    merged = merged.union(self.spark.table(name))
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._run(merged))
                self._drop(names)
                self.levels[level] = []

    def repeated(self, min_docs: int) -> DataFrame:
        """``hash``, ``last_doc`` of the lines that at least ``min_docs`` documents hold."""
        known = self.rows()
        for more in self.again:
            known = known.union(more)
        found = known.groupBy("hash").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
        return written(found.filter(F.col("n_docs") >= min_docs).drop("n_docs"), "repeated-lines")

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        self._drop(self._names())
        self.levels = [[]]


def _hash(line: str) -> bytes:
    return hashlib.md5(line.strip(_WHITE).translate(_FOLD).encode()).digest()


def _without(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, drops in parts:
        out = []
        for text, drop in zip(texts, drops, strict=True):
            lines = text.split("\n")
            if drop is None:
                out.append((text, len(lines), 0))
                continue
            gone = set(drop)
            kept = [line for line in lines if _hash(line) not in gone]
            out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        yield pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def without_repeated_lines(
    docs: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``row`` (the whole row of ``docs``) and ``lines`` (``text`` left, ``n_lines`` before, ``n_dropped``).

    A key of at least ``min_chars`` code points in at least ``min_docs``
    documents loses all its lines except in the largest document holding it.
    Documents arrive in ``batches`` by a hash of their number.
    """
    spark = docs.sparkSession
    hashes = written(
        line_hashes(docs, min_chars, id_col, text_col).withColumn("batch", F.pmod(F.hash("doc_id"), F.lit(batches))),
        "line-hashes",
        "batch",
    )
    runs = LineRuns(spark)
    try:
        for batch in range(batches):
            runs.add(hashes.filter(F.col("batch") == batch).drop("batch"))
        repeated = runs.repeated(min_docs)
    finally:
        runs.close()
    drops = (
        hashes.join(repeated, "hash")
        .filter("doc_id != last_doc")
        .groupBy("doc_id")
        .agg(F.collect_list("hash").alias("drops"))
    )
    without = F.pandas_udf(_without, "text string, n_lines long, n_dropped long")
    packed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.struct("*").alias("row"))
    return packed.join(drops, "doc_id", "left").select(
        "row", without(F.coalesce(F.col("row")[text_col], F.lit("")), "drops").alias("lines")
    )
