"""Parquet event tables, the better format for anything read more than once."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clicktally.functions.events import with_event_date
from clicktally.operators.checks import conform
from clicktally.sources.scratch import scratch_path, scratch_scope

ROW_ID = "row_id"


def read_events_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Read event tables by column name, in the types of the schema; raises ValueError if a column is
    absent or of a type that can't be converted."""
    return conform(spark.read.parquet(*paths))


def stage_events(events: DataFrame, path: str, *, file_order: bool = False) -> DataFrame:
    """Write the columns the queries use to Parquet and return the written table.

    ``row_id`` numbers the rows once, on the way to storage, so later queries see
    the same numbers whatever executors come and go.  By default the numbers rise
    in the order in which Spark deals the rows to tasks, which for one file is the
    order of its lines; several files come in no promised order.

    With ``file_order`` the rows are numbered from 0 without a gap: files by their
    path, lines as they stand.  ``events`` must come straight from files.
    """
    spark = events.sparkSession
    columns = ["event_type", "event_date", "brand", "price"]
    dated = with_event_date(events)
    with scratch_scope(spark):
        if file_order:
            numbered = _in_file_order(dated, columns)
        else:
            numbered = dated.select(F.monotonically_increasing_id().alias(ROW_ID), *columns)
        numbered.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _in_file_order(events: DataFrame, columns: list[str]) -> DataFrame:
    """The columns with the place of each row over all files.

    A task reads a split (a stretch of a file) from its first line to its last, so
    within a split the running numbers of rows are consecutive.  Where a split
    starts follows from the row counts of the splits before it, by path and then
    by place in the file.  The rows are stored in between: a second reading might
    cut the files elsewhere.
    """
    spark = events.sparkSession
    split = ["file_path", "file_block_start"]
    read = events.select(
        F.monotonically_increasing_id().alias("seq"), *[F.col(f"_metadata.{name}").alias(name) for name in split], *columns
    )
    stored = scratch_path(spark, "rows-of-splits")
    read.write.parquet(stored)
    rows = spark.read.schema(read.schema).parquet(stored)
    # One row per split, and the size of splits grows with the input (see the jobs' settings): a window can hold them.
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*split)
        .agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("rows"))
        .select("first", *split, F.coalesce(F.sum("rows").over(before), F.lit(0).cast("bigint")).alias("start"))
    )
    return rows.join(starts, split).select((F.col("seq") - F.col("first") + F.col("start")).alias(ROW_ID), *columns)
