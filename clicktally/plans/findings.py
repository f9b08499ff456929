"""Questions one asks of the three results: conversion, gaps, spikes, price mix."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktally.functions.events import has_brand, is_purchase, valid_price, with_event_date
from clicktally.operators.quantiles import counted_quantiles
from clicktally.operators.totals import revenue_by
from clicktally.schema import PURCHASE, VIEW


def conversion_columns(df: DataFrame, events_of: Callable[[str], Column]) -> DataFrame:
    """One row of view and purchase counts and their ratios, NULL where undefined."""
    counts = df.agg(events_of(VIEW).alias("num_views"), events_of(PURCHASE).alias("num_purchases"))
    views, purchases = F.col("num_views"), F.col("num_purchases")
    return counts.select(
        views,
        purchases,
        F.try_divide(purchases, views).alias("conversion_rate"),
        F.try_divide(views, purchases).alias("views_per_purchase"),
    )


def conversion_rate(events: DataFrame) -> DataFrame:
    """How many purchases there are per view, and views per purchase."""
    return conversion_columns(events, lambda kind: F.count_if(F.col("event_type") == kind))


def missing_days(events: DataFrame, *by: str) -> DataFrame:
    """Calendar days without an event between the first and the last day seen, for each group of ``by``.

    Filter the events first to ask about one kind, e.g. days without a purchase.
    """
    days = with_event_date(events).select(*by, "event_date").distinct()
    # A window holds the distinct days of a group, never events, and four-digit
    # years bound those.  It also reads the events only once.  A NULL day sorts
    # first and has no distance to the next, so it opens no gap.
    following = F.lead("event_date").over(Window.partitionBy(*by).orderBy("event_date"))
    gaps = days.withColumn("following", following).filter(F.date_diff("following", "event_date") > 1)
    return gaps.select(
        *by, F.explode(F.sequence(F.date_add("event_date", 1), F.date_sub("following", 1))).alias("event_date")
    ).orderBy(*by, "event_date")


def daily_spikes(daily: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Days whose revenue is at least ``threshold`` times that of the median day.

    ``daily`` is the result of a daily revenue query, one row per calendar day,
    so the single window partition holds days and not events.
    """
    every_day = Window.partitionBy()
    median = F.median("total_revenue").over(every_day)
    rated = daily.filter(F.col("event_date").isNotNull()).select(
        "event_date",
        "num_purchases",
        "total_revenue",
        F.round(F.try_divide(F.col("total_revenue"), median), 4).alias("times_median"),
    )
    return rated.filter(F.col("times_median") >= threshold).orderBy("event_date")


def typical_day(daily: DataFrame) -> DataFrame:
    """Quartiles of purchases, revenue and mean price over the days, one row per measure."""
    measures = ["num_purchases", "total_revenue", "avg_order_value"]
    quartiles = {"low": 0.25, "middle": 0.5, "high": 0.75}
    bands = daily.filter(F.col("event_date").isNotNull()).agg(
        *[
            F.percentile(F.col(name).cast("double"), F.array(*map(F.lit, quartiles.values()))).alias(name)
            for name in measures
        ]
    )
    per_measure = bands.select(
        F.explode(F.create_map(*[item for name in measures for item in (F.lit(name), F.col(name))])).alias(
            "measure", "band"
        )
    )
    return per_measure.select(
        "measure",
        # A quartile between two amounts in cents has at most four decimals.
        *[F.round(F.col("band")[i], 4).alias(name) for i, name in enumerate(quartiles)],
    ).orderBy("measure")


def brand_price_mix(events: DataFrame) -> DataFrame:
    """Volume next to mean selling price per brand: what sells often against what sells dear."""
    return (
        revenue_by(
            events.filter(is_purchase() & has_brand()),
            "brand",
            F.col("price"),
            count="num_purchases",
            revenue="estimated_revenue",
            average="avg_selling_price",
        )
        .orderBy(F.desc("num_purchases"), "brand")
    )


def price_counts(events: DataFrame) -> DataFrame:
    """How many purchases each brand has at each valid price: a rollup from which quantiles can be taken."""
    priced = events.filter(is_purchase() & has_brand()).select("brand", valid_price().alias("price"))
    return priced.filter(F.col("price").isNotNull()).groupBy("brand", "price").agg(F.count(F.lit(1)).alias("num_priced"))


def brand_price_quartiles(counts: DataFrame) -> DataFrame:
    """The typical price of each brand, and the prices a quarter of its purchases stay below or go beyond.

    ``counts`` is the result of :func:`price_counts`, or several of them put together.  Quartiles are exact;
    one between two prices is rounded to six decimals.
    """
    merged = counts.groupBy("brand", "price").agg(F.sum("num_priced").alias("num_priced"))
    names = {"low": 0.25, "middle": 0.5, "high": 0.75}
    found = counted_quantiles(merged, "brand", "price", "num_priced", names)
    return found.select("brand", "num_priced", *[F.round(name, 6).alias(name) for name in names]).orderBy("brand")
