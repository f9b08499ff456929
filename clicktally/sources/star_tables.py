"""A clickstream table derived from an ``events`` and a ``part`` table.

``events`` carries the product number inside a JSON text and no brand; the
brand, type and size come from ``part``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_EVENTS = """
    event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING
"""
_PART = "p_partkey BIGINT, p_brand STRING, p_type STRING, p_size INT"

# Fixed damage, by event number: column -> (period, {slot: replacement}).
_DAMAGE = {
    "event_time": (31, {0: "'2024-02-30 00:00:00 UTC'", 1: "'garbage'"}),
    "event_type": (29, {0: "NULL"}),
    "brand": (20, {0: "NULL", 1: "''", 2: "'   '"}),
    "price": (23, {0: "NULL", 1: "0D", 2: "-price", 3: "double('NaN')", 4: "price + 0.005D"}),
}


def read_star_events(spark: SparkSession, folder: str) -> DataFrame:
    """The event columns that need no join: time, type, product, price and user."""
    events = spark.read.schema(_EVENTS).parquet(f"{folder}/events.parquet")
    # The text form of ts does not depend on the session time zone.
    return events.selectExpr(
        "event_id",
        "substring(string(ts), 1, 19) || ' UTC' AS event_time",
        "event_type",
        "try_cast(get_json_object(props, '$.k') AS BIGINT) AS product_id",
        "value AS price",
        "user_id",
        "user_id || '-' || substring(string(ts), 1, 10) AS user_session",
    )


def read_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    """All nine event columns plus ``event_id``.

    The join carries no broadcast hint: Spark broadcasts ``part`` only while its
    measured size is below the threshold, and beyond it splits skewed products
    at run time.
    """
    part = spark.read.schema(_PART).parquet(f"{folder}/part.parquet")
    product = part.selectExpr(
        "p_partkey AS product_id",
        "bigint(p_size) AS category_id",
        "lower(p_type) AS category_code",
        "lower(p_brand) AS brand",
    )
    return (
        read_star_events(spark, folder)
        .join(product, "product_id", "left")
        .select(
            "event_id",
            "event_time",
            "event_type",
            "product_id",
            "category_id",
            "category_code",
            "brand",
            "price",
            "user_id",
            "user_session",
        )
    )


def damaged(clickstream: DataFrame) -> DataFrame:
    """The same rows with fixed damage to time, type, brand and price, to exercise the edge rules."""

    def case(column: str) -> str:
        period, slots = _DAMAGE[column]
        cases = " ".join(f"WHEN {slot} THEN {value}" for slot, value in slots.items())
        return f"CASE event_id % {period} {cases} ELSE {column} END"

    return clickstream.withColumns(
        {column: F.expr(case(column)) for column in _DAMAGE if column in clickstream.columns}
    )
