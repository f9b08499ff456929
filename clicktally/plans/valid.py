"""Daily and brand revenue over valid prices only.

A missing, zero, negative or NaN price adds nothing to revenue or mean, but its
purchase still counts.  Unreadable days and whitespace-only brands are left out.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.functions.events import (
    has_nonblank_brand,
    is_purchase,
    valid_price,
    with_event_date,
)
from clicktally.operators.totals import revenue_by, top_by

_MEASURES = {
    "count": "num_purchase_events",
    "revenue": "estimated_revenue",
    "average": "avg_purchase_event_value",
}


def valid_daily_revenue(events: DataFrame) -> DataFrame:
    purchases = with_event_date(events).filter(is_purchase() & F.col("event_date").isNotNull())
    return revenue_by(purchases, "event_date", valid_price(), **_MEASURES).orderBy("event_date")


def valid_top_brands(events: DataFrame, k: int = 10) -> DataFrame:
    """Brands keep their own spelling: surrounding spaces are tested, not trimmed."""
    purchases = events.filter(is_purchase() & has_nonblank_brand())
    per_brand = revenue_by(purchases, "brand", valid_price(), **_MEASURES)
    return top_by(per_brand, "estimated_revenue", "brand", k).select(
        "brand", "estimated_revenue", "num_purchase_events", "avg_purchase_event_value"
    )
