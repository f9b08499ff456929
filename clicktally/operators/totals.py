"""Grouped counts, sums and shares."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktally.functions import money
from clicktally.functions.events import percentage


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def with_share(counts: DataFrame, count: str, share: str) -> DataFrame:
    """Add each row's percentage of the column total.

    ``counts`` holds a row per group; its total is taken over these few rows, so
    the events are grouped once however they are partitioned.
    """
    total = F.sum(count).over(Window.partitionBy())
    return counts.withColumn(share, percentage(F.col(count), total))


def revenue_by(
    purchases: DataFrame,
    key: str,
    price: Column,
    *,
    count: str,
    revenue: str,
    average: str | None = None,
) -> DataFrame:
    """Per key: number of rows, summed price and (if named) mean price, exact and then rounded to cents.

    Rows without a price count but add nothing to the sum or the mean.
    """
    sums = purchases.groupBy(key).agg(F.count(F.lit(1)).alias(count), *money.totals(price, "price"))
    measures = [F.col(count), money.revenue("price").alias(revenue)]
    if average:
        measures.append(money.average("price").alias(average))
    return sums.select(key, *measures)


def top_by(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    """The k rows with the largest measure; equal measures are ordered by key."""
    return df.orderBy(F.desc(measure), F.asc(key)).limit(k)
