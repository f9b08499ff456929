"""Clickstream analytics as plain PySpark DataFrame queries.

Every function takes and returns DataFrames (or Columns) and none creates a
session.  The input is one flat event table, see :mod:`clicktally.schema`.
"""

from clicktally.operators.checks import require_columns
from clicktally.operators.first_n import first_n
from clicktally.plans.direct import (
    daily_purchase_revenue,
    event_distribution,
    top_brands,
    total_events,
)
from clicktally.plans.findings import (
    brand_price_mix,
    brand_price_quartiles,
    conversion_rate,
    daily_spikes,
    missing_days,
    price_counts,
    typical_day,
)
from clicktally.plans.growing import read_growing_rollup, update_rollup
from clicktally.plans.rollup import (
    brand_price_mix_from_rollup,
    conversion_rate_from_rollup,
    daily_purchase_revenue_from_rollup,
    event_distribution_from_rollup,
    event_rollup,
    rejected_rows_from_rollup,
    top_brands_from_rollup,
    valid_daily_revenue_from_rollup,
    valid_top_brands_from_rollup,
)
from clicktally.plans.scalability import (
    completed_runs,
    largest_completed,
    scalability_rows,
    scalability_run,
)
from clicktally.plans.valid import valid_daily_revenue, valid_top_brands
from clicktally.sinks.results import read_result, write_result
from clicktally.sinks.versions import current_version, publish
from clicktally.sources.csv_events import read_events_csv, rejected_rows
from clicktally.sources.parquet_events import read_events_parquet, stage_events

__all__ = [
    "brand_price_mix",
    "brand_price_mix_from_rollup",
    "brand_price_quartiles",
    "completed_runs",
    "conversion_rate",
    "conversion_rate_from_rollup",
    "current_version",
    "daily_purchase_revenue",
    "daily_purchase_revenue_from_rollup",
    "daily_spikes",
    "event_distribution",
    "event_distribution_from_rollup",
    "event_rollup",
    "first_n",
    "largest_completed",
    "missing_days",
    "price_counts",
    "publish",
    "read_events_csv",
    "read_events_parquet",
    "read_growing_rollup",
    "read_result",
    "rejected_rows",
    "rejected_rows_from_rollup",
    "require_columns",
    "scalability_rows",
    "scalability_run",
    "stage_events",
    "top_brands",
    "top_brands_from_rollup",
    "total_events",
    "typical_day",
    "update_rollup",
    "valid_daily_revenue",
    "valid_daily_revenue_from_rollup",
    "valid_top_brands",
    "valid_top_brands_from_rollup",
    "write_result",
]
