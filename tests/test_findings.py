"""Conversion, gaps, spikes and typical days on small hand-made tables."""

import datetime

import clicktally as ct


def days(df):
    return [row["event_date"].isoformat() for row in df.collect()]


def events_on(spark, dates):
    return spark.createDataFrame([(d,) for d in dates], "event_time string")


def test_missing_days_spans_months(spark):
    events = events_on(spark, ["2024-02-27 x", "2024-02-27 y", "2024-03-02 x", "2024-03-03 x", "garbage", None])
    assert days(ct.missing_days(events)) == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_no_missing_days(spark):
    assert days(ct.missing_days(events_on(spark, ["2024-02-28 x", "2024-02-29 x"]))) == []
    assert days(ct.missing_days(events_on(spark, ["2024-02-28 x"]))) == []
    assert days(ct.missing_days(events_on(spark, ["garbage"]))) == []


def test_missing_days_of_each_group(spark):
    events = spark.createDataFrame(
        [("2024-01-01 x", "a"), ("2024-01-03 x", "a"), ("2024-01-09 x", "b"), ("2024-01-11 x", None), ("2024-01-13 x", None)],
        "event_time string, brand string",
    )
    found = ct.missing_days(events, "brand").collect()
    assert [(row["brand"], row["event_date"].isoformat()) for row in found] == [(None, "2024-01-12"), ("a", "2024-01-02")]


def daily(spark, revenues):
    start = datetime.date(2019, 11, 1)
    rows = [(start + datetime.timedelta(days=i), 10 + i, r, 5.0) for i, r in enumerate(revenues)]
    return spark.createDataFrame(
        [(None, 1, 1e9, 1.0), *rows],
        "event_date date, num_purchases bigint, total_revenue double, avg_order_value double",
    )


def test_spikes_against_the_median_day(spark):
    spikes = ct.daily_spikes(daily(spark, [7.0, 8.0, 57.7, 7.5, 16.0]), 2.0).collect()
    assert [(row["event_date"].day, row["times_median"]) for row in spikes] == [(3, 7.2125), (5, 2.0)]


def test_spikes_without_revenue(spark):
    assert ct.daily_spikes(daily(spark, [0.0, 0.0])).count() == 0


def test_typical_day_quartiles(spark):
    bands = {row["measure"]: (row["low"], row["middle"], row["high"])
             for row in ct.typical_day(daily(spark, [1.0, 2.0, 3.0, 4.0])).collect()}
    assert bands["total_revenue"] == (1.75, 2.5, 3.25)
    assert bands["num_purchases"] == (10.75, 11.5, 12.25)
    assert bands["avg_order_value"] == (5.0, 5.0, 5.0)


def test_conversion(spark):
    events = spark.createDataFrame([(t,) for t in ["view"] * 8 + ["purchase"] * 2 + ["cart", None]], "event_type string")
    assert tuple(ct.conversion_rate(events).first()) == (8, 2, 0.25, 4.0)
