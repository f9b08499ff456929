"""The three questions straight from the events, summing every recorded price."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.functions.events import has_brand, is_purchase, with_event_date
from clicktally.operators.totals import count_by, revenue_by, top_by, with_share


def total_events(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("total_events"))


def event_distribution(events: DataFrame) -> DataFrame:
    """Count and share of each event type, most frequent first.  A NULL type is a group too."""
    shares = with_share(count_by(events, "event_type", "event_count"), "event_count", "pct_of_total")
    return shares.orderBy(F.desc("event_count"), "event_type")


def daily_purchase_revenue(events: DataFrame) -> DataFrame:
    """Purchases, revenue and mean price per day.  Unreadable days form one NULL group.

    ``avg_order_value`` is the mean per purchase event; events carry no order number.
    """
    purchases = with_event_date(events).filter(is_purchase())
    return revenue_by(
        purchases,
        "event_date",
        F.col("price"),
        count="num_purchases",
        revenue="total_revenue",
        average="avg_order_value",
    ).orderBy("event_date")


def top_brands(events: DataFrame, k: int = 10) -> DataFrame:
    """The k brands with the largest purchase revenue, ranked by the rounded sum."""
    per_brand = revenue_by(
        events.filter(is_purchase() & has_brand()),
        "brand",
        F.col("price"),
        count="num_purchases",
        revenue="estimated_revenue",
    )
    return top_by(per_brand, "estimated_revenue", "brand", k).select(
        "brand", "estimated_revenue", "num_purchases"
    )
