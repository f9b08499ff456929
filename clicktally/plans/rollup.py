"""One pass over the events, then every question from the small rollup.

The rollup has one row per event type, day and brand.  Its counts and integer
cents can be added up again along any of the three, so all queries below read
the rollup and never the events, and give the same cents on every run.
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.functions import money
from clicktally.functions.events import (
    has_brand,
    has_nonblank_brand,
    is_purchase,
    valid_price,
    with_event_date,
)
from clicktally.operators.totals import top_by, with_share
from clicktally.plans.findings import conversion_columns
from clicktally.sources.csv_events import REJECT_COLUMN, rejected_line
from clicktally.sources.scratch import replace_folder

#: Lines with a field that did not parse, in rollups of events read with ``keep_rejected=True``.
REJECTED_COUNT = "rejected_count"


def event_rollup(events: DataFrame) -> DataFrame:
    """Counts and sums per (event_type, event_date, brand), NULLs included.

    The ``price_`` columns are the parts of :mod:`clicktally.functions.money`
    over all prices, the ``valid_`` columns the same over valid prices.  Events
    that were read with their rejected lines add ``rejected_count``: counting
    them is part of the same pass, and stays exact when tasks run again.
    """
    counts = [F.count(F.lit(1)).alias("event_count")]
    rejected = []
    if REJECT_COLUMN in events.columns:
        rejected = [rejected_line().alias(REJECT_COLUMN)]
        counts.append(F.count(REJECT_COLUMN).alias(REJECTED_COUNT))
    priced = with_event_date(events).select(
        "event_type", "event_date", "brand", "price", valid_price().alias("valid_price"), *rejected
    )
    return priced.groupBy("event_type", "event_date", "brand").agg(
        *counts,
        *money.parts(F.col("price"), "price"),
        *money.parts(F.col("valid_price"), "valid"),
    )


def write_rollup(events: DataFrame, path: str) -> DataFrame:
    """Store the rollup as Parquet and return the stored table.

    It is written beside the old one, which goes only once the new one is complete.
    """
    fresh = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    event_rollup(events).write.parquet(fresh)
    replace_folder(events.sparkSession, fresh, path)
    return events.sparkSession.read.parquet(path)


def _sums_by(rollup: DataFrame, key: str, prefix: str) -> DataFrame:
    return rollup.groupBy(key).agg(F.sum("event_count").alias("events"), *money.added_totals(prefix))


def total_events_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.agg(F.coalesce(F.sum("event_count"), F.lit(0).cast("bigint")).alias("total_events"))


def rejected_rows_from_rollup(rollup: DataFrame) -> DataFrame:
    """One row: how many lines were read, and how many held a field that did not parse."""
    none = F.lit(0).cast("bigint")
    return rollup.agg(
        F.coalesce(F.sum("event_count"), none).alias("total_rows"),
        F.coalesce(F.sum(REJECTED_COUNT), none).alias("rejected_rows"),
    )


def event_distribution_from_rollup(rollup: DataFrame) -> DataFrame:
    counts = rollup.groupBy("event_type").agg(F.sum("event_count").alias("event_count"))
    return with_share(counts, "event_count", "pct_of_total").orderBy(
        F.desc("event_count"), "event_type"
    )


def daily_purchase_revenue_from_rollup(rollup: DataFrame) -> DataFrame:
    daily = _sums_by(rollup.filter(is_purchase()), "event_date", "price")
    return daily.select(
        "event_date",
        F.col("events").alias("num_purchases"),
        money.revenue("price").alias("total_revenue"),
        money.average("price").alias("avg_order_value"),
    ).orderBy("event_date")


def top_brands_from_rollup(rollup: DataFrame, k: int = 10) -> DataFrame:
    brands = _sums_by(rollup.filter(is_purchase() & has_brand()), "brand", "price").select(
        "brand",
        money.revenue("price").alias("estimated_revenue"),
        F.col("events").alias("num_purchases"),
    )
    return top_by(brands, "estimated_revenue", "brand", k)


def valid_daily_revenue_from_rollup(rollup: DataFrame) -> DataFrame:
    purchases = rollup.filter(is_purchase() & F.col("event_date").isNotNull())
    return _valid_measures(purchases, "event_date").orderBy("event_date")


def valid_top_brands_from_rollup(rollup: DataFrame, k: int = 10) -> DataFrame:
    brands = _valid_measures(rollup.filter(is_purchase() & has_nonblank_brand()), "brand")
    return top_by(brands, "estimated_revenue", "brand", k)


def _valid_measures(purchases: DataFrame, key: str) -> DataFrame:
    return _sums_by(purchases, key, "valid").select(
        key,
        money.revenue("valid").alias("estimated_revenue"),
        F.col("events").alias("num_purchase_events"),
        money.average("valid").alias("avg_purchase_event_value"),
    )


def conversion_rate_from_rollup(rollup: DataFrame) -> DataFrame:
    def events_of(kind: str):
        return F.coalesce(
            F.sum(F.when(F.col("event_type") == kind, F.col("event_count"))),
            F.lit(0).cast("bigint"),
        )

    return conversion_columns(rollup, events_of)


def brand_price_mix_from_rollup(rollup: DataFrame) -> DataFrame:
    brands = _sums_by(rollup.filter(is_purchase() & has_brand()), "brand", "price")
    return brands.select(
        "brand",
        F.col("events").alias("num_purchases"),
        money.revenue("price").alias("estimated_revenue"),
        money.average("price").alias("avg_selling_price"),
    ).orderBy(F.desc("num_purchases"), "brand")
