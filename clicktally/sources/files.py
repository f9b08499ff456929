"""Files below a path as a table, so that their list stays in Spark."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_SCHEMA = "path string, length bigint, modified timestamp"


def file_table(
    spark: SparkSession, paths: str | Sequence[str], *, recursive: bool = False, file_name: str | None = None
) -> DataFrame:
    """``path``, ``length`` and ``modified`` (time of the last change) of each file, without opening any."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if file_name:
        reader = reader.option("pathGlobFilter", file_name)
    found = reader.load(paths if isinstance(paths, str) else list(paths))
    return found.select("path", "length", F.col("modificationTime").alias("modified"))
