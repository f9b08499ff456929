"""Checks and conversions on table metadata; none of them starts a job."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from clicktally.schema import event_columns, event_schema


def require_columns(df: DataFrame, required: Iterable[str] | None = None) -> DataFrame:
    """Return ``df`` unchanged, or raise ValueError naming the absent columns."""
    present = set(df.columns)
    absent = [name for name in (required or event_columns()) if name not in present]
    if absent:
        raise ValueError(f"event table lacks the columns {', '.join(absent)}")
    return df


def _as(column: Column, have: DataType, want: DataType) -> Column | None:
    """The column in the wanted type, or None if that type can't hold what is there."""
    if have == want:
        return column
    if isinstance(want, StringType):
        # Days are taken from the text, so an instant is written in UTC whatever the session's zone.
        if isinstance(have, TimestampType):
            column = F.convert_timezone(None, F.lit("UTC"), column.cast("timestamp_ntz"))
        if isinstance(have, (TimestampType, TimestampNTZType)):
            return F.concat(F.date_format(column, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
        return column.cast("string") if isinstance(have, DateType) else None
    return column.try_cast(want) if isinstance(have, NumericType) else None


def conform(df: DataFrame) -> DataFrame:
    """The event columns of ``df`` in the types of the schema, other columns as they are.

    Numbers become the schema's numbers and timestamps texts in UTC; a column
    of any other type raises ValueError naming it.
    """
    require_columns(df)
    changed, unfit = {}, []
    for field in event_schema():
        have = df.schema[field.name].dataType
        column = _as(F.col(field.name), have, field.dataType)
        if column is None:
            unfit.append(f"{field.name} ({have.simpleString()} instead of {field.dataType.simpleString()})")
        elif have != field.dataType:
            changed[field.name] = column
    if unfit:
        raise ValueError(f"event table has unfit types: {', '.join(unfit)}")
    return df.withColumns(changed) if changed else df
