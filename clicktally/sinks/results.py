"""Result tables as CSV folders."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: CSV options under which every text comes back as it was.  A quote inside a quoted text is doubled.
LOSSLESS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}

#: NULL is written as nothing and an empty text as two quotes.  Spark's reader takes both for its null
#: value, so that must be something no result holds.
_NO_TEXT = "\x00"


def write_result(
    result: DataFrame, base: str, name: str, *, preview_rows: int = 0, single_file: bool = False
) -> str:
    """Write ``result`` to the CSV folder ``base/name``, replacing it, and return that path.

    Every partition writes its own file.  ``single_file`` is for results of
    bounded size, such as one row per day or the top ten; the last step of the
    query then runs as one task.  A preview shows the first rows of what was
    written, so the query runs once.  Texts keep their spaces, line breaks and
    quotes, and NULL and empty texts stay different.
    """
    path = f"{base.rstrip('/')}/{name}"
    output = result.coalesce(1) if single_file else result
    output.write.csv(path, mode="overwrite", header=True, **LOSSLESS)
    if preview_rows:
        read_result(result.sparkSession, path, result.schema).show(preview_rows, truncate=False)
    return path


def read_result(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, multiLine=True, nullValue=_NO_TEXT, **LOSSLESS)
