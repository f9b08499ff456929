"""The event table: nine columns, one row per user event."""

from pyspark.sql.types import StructType

# Names, order and types of the columns in an event file.
EVENT_SCHEMA_DDL = """
    event_time STRING,
    event_type STRING,
    product_id BIGINT,
    category_id BIGINT,
    category_code STRING,
    brand STRING,
    price DOUBLE,
    user_id BIGINT,
    user_session STRING
"""

# Event types the revenue and conversion queries look for.
PURCHASE = "purchase"
VIEW = "view"


def event_schema() -> StructType:
    return StructType.fromDDL(EVENT_SCHEMA_DDL)


def event_columns() -> list[str]:
    return event_schema().fieldNames()
