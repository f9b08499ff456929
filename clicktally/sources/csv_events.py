"""CSV event files with a header line."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.schema import event_columns, event_schema
from clicktally.sources.files import file_table

REJECT_COLUMN = "_rejected"


def read_events_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    recursive: bool = False,
    file_name: str | None = None,
    keep_rejected: bool = False,
) -> DataFrame:
    """Read event CSVs with the fixed schema; no pass over the data to infer types.

    ``paths`` may be one path or several, may hold globs and may point to any
    file system Spark knows.  ``recursive`` searches all folders below and
    ``file_name`` keeps only files whose name matches that glob; a recursive
    search that finds no file raises FileNotFoundError.

    A header that does not match the schema fails the read instead of loading
    columns into each other's place.  A field that does not parse becomes NULL;
    ``keep_rejected`` adds the text of such lines in an extra column.
    """
    schema = event_schema()
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if keep_rejected:
        schema = schema.add(REJECT_COLUMN, "string")
        reader = reader.option("columnNameOfCorruptRecord", REJECT_COLUMN)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if file_name:
        reader = reader.option("pathGlobFilter", file_name)

    events = reader.schema(schema).csv(paths if isinstance(paths, str) else list(paths))
    if recursive and file_table(spark, paths, recursive=True, file_name=file_name).isEmpty():
        raise FileNotFoundError(f"no files named {file_name or '*'} below {paths}")
    return events


def rejected_line() -> Column:
    """Not NULL if a line read with ``keep_rejected=True`` held a field that did not parse; for ``count``."""
    # Referring to every column makes the scan parse every field; a pruned scan
    # would not notice bad text in a column it skips.
    return F.when(F.col(REJECT_COLUMN).isNotNull(), F.struct(*event_columns()))


def rejected_rows(events: DataFrame) -> DataFrame:
    """One row: how many lines were read, and how many held a field that did not parse.

    ``events`` comes from ``read_events_csv(..., keep_rejected=True)``.
    """
    return events.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count(rejected_line()).alias("rejected_rows")
    )
