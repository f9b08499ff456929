"""A stored rollup that grows with its input: only files not counted yet are read.

Each version of the store (see :mod:`clicktally.sinks.versions`) holds the rollup
and the list of files it counts, so both change together or not at all.  Adding
files reads those files and the stored rollup, which has a row for each event
type, day and brand and not for each event.  Running again without new files
changes nothing, and a run that dies is simply run again.

Files go in by the thousands, each lot a version of its own: no list of all
files ever leaves Spark, and a long first run goes on where it stopped.  A file
that vanishes stays counted; one whose size or time changed is an error, because
what it added before cannot be taken back.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clicktally.functions import money
from clicktally.plans.rollup import REJECTED_COUNT, event_rollup
from clicktally.sinks.versions import current_version, publish
from clicktally.sources.csv_events import read_events_csv
from clicktally.sources.files import FILE_SCHEMA, file_table

FILES_A_LOT = 5_000


def merged_rollups(rollups: DataFrame) -> DataFrame:
    """The rollup of all events behind the rows of several rollups."""
    rejected = [F.sum(REJECTED_COUNT).alias(REJECTED_COUNT)] if REJECTED_COUNT in rollups.columns else []
    return rollups.groupBy("event_type", "event_date", "brand").agg(
        F.sum("event_count").alias("event_count"), *rejected, *money.added_parts("price"), *money.added_parts("valid")
    )


def update_rollup(
    spark: SparkSession,
    base: str,
    paths: str | Sequence[str],
    *,
    recursive: bool = False,
    file_name: str | None = None,
    read: Callable[[SparkSession, list[str]], DataFrame] = read_events_csv,
    files_a_lot: int = FILES_A_LOT,
) -> DataFrame | None:
    """Count the files of ``paths`` that the rollup below ``base`` does not hold yet; the rollup, None while there is none."""
    listed = file_table(spark, paths, recursive=recursive, file_name=file_name)
    while lot := _uncounted(spark, base, listed, files_a_lot):
        stored = current_version(spark, base)
        fresh = event_rollup(read(spark, [row[0] for row in lot]))
        files = spark.createDataFrame(lot, FILE_SCHEMA)
        if stored:
            fresh = merged_rollups(read_growing_rollup(spark, base).unionByName(fresh))
            files = files.unionByName(spark.read.schema(FILE_SCHEMA).parquet(f"{stored}/files"))

        def write(folder: str) -> None:
            fresh.write.parquet(f"{folder}/rollup")  # noqa: B023
            files.write.parquet(f"{folder}/files")  # noqa: B023

        publish(spark, base, write)
    return read_growing_rollup(spark, base)


def _uncounted(spark: SparkSession, base: str, listed: DataFrame, most: int) -> list:
    """The first files that are not counted, ``most`` of them; ValueError if a counted one has changed."""
    stored = current_version(spark, base)
    if not stored:
        return listed.orderBy("path").limit(most).collect()
    counted = spark.read.schema(FILE_SCHEMA).parquet(f"{stored}/files")
    old = counted.select("path", F.struct("length", "modified").alias("old"))
    both = listed.join(old, "path", "left").withColumn("changed", F.col("old") != F.struct("length", "modified"))
    found = both.filter("old is null or changed").orderBy(F.desc_nulls_last("changed"), "path").limit(most).collect()
    if found and found[0]["changed"]:
        raise ValueError(f"{found[0]['path']} has changed since it was counted; build the rollup anew in another folder")
    return [Row(*[row[name] for name in ("path", "length", "modified")]) for row in found]


def read_growing_rollup(spark: SparkSession, base: str) -> DataFrame | None:
    """The rollup in force below ``base``."""
    stored = current_version(spark, base)
    return spark.read.parquet(f"{stored}/rollup") if stored else None
