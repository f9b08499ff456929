"""Column expressions one by one."""

import datetime

import pytest
from clicktally.functions import money
from clicktally.functions.events import event_date, has_brand, has_nonblank_brand, valid_price
from compare import plain
from pyspark.sql import functions as F


@pytest.mark.parametrize("time_zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_event_date_agrees_with_strict_pattern(spark, time_zone, ansi):
    texts = [
        "2019-11-01 00:00:00 UTC", "2019-11-01", "2019-11-01T00:00:00", "2024-02-29 x", "2023-02-29 x",
        "2019-11-31 00:00:03 UTC", "2019-00-10", "2019-13-10", "2019-11-1 00:00", "2019-1-11 00:00",
        "2019-1-1 00:00:00", "2019-11", "2019", "2019-11   ", "2019      ", " 2019-11-01", "+2019-1-01",
        "12019-1-01", "120190-1-1", "1234567-01", "-2019-11-01", "2019-11-1T00", "2019/11/01", "garbage",
        "", "2019-11-0a", "0001-01-01 x", "9999-12-31 x", "2018-11-04 00:00:00 UTC", None,
    ]
    previous = {name: spark.conf.get(name) for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        days = spark.createDataFrame([(text,) for text in texts], "event_time string").select(
            "event_time",
            event_date().alias("ours"),
            F.try_to_date(F.substring("event_time", 1, 10), "yyyy-MM-dd").alias("strict"),
        )
        for row in days.collect():
            assert row["ours"] == row["strict"], row
    finally:
        for name, value in previous.items():
            spark.conf.set(name, value)


def test_event_date_reads_only_the_first_ten_characters(spark):
    events = spark.createDataFrame([("2019-11-01garbage",)], "event_time string")
    assert events.select(event_date()).first()[0] == datetime.date(2019, 11, 1)


def test_valid_price(spark):
    cases = {1.5: 1.5, 0.0: None, -0.01: None, float("nan"): None, float("inf"): float("inf"), None: None}
    got = spark.createDataFrame([(p,) for p in cases], "price double").select(valid_price()).collect()
    assert [row[0] for row in got] == list(cases.values())


def test_brand_predicates(spark):
    brands = ["lg", " lg ", "", "   ", "\t\n", " ", " ", "\x1c", None]
    got = spark.createDataFrame([(b,) for b in brands], "brand string").select(
        "brand", has_brand().alias("has"), has_nonblank_brand().alias("nonblank")
    )
    for brand, has, nonblank in got.collect():
        assert bool(has) == (brand is not None and brand != "")
        assert bool(nonblank) == (brand is not None and brand.strip() != "")


def test_whole_cents_splits_exactly(spark):
    cases = {
        0.01: 1, 0.29: 29, 1.1: 110, 53.405: None, 10.005: None, -3.0: -300, 0.0: 0, -0.0: 0,
        123456789.99: 12345678999, 1e12: 10**14, 1e13: None, 1e300: None,
        float("nan"): None, float("inf"): None, float("-inf"): None, None: None,
    }
    got = spark.createDataFrame([(p,) for p in cases], "price double").select(money.whole_cents(F.col("price")))
    assert [row[0] for row in got.collect()] == list(cases.values())


def test_every_price_in_cents_is_recognised(spark):
    cents = spark.range(-200_000, 2_000_000, 7).select("id", (F.col("id") / 100.0).alias("price"))
    assert cents.filter(~F.col("id").eqNullSafe(money.whole_cents(F.col("price")))).count() == 0


def test_mean_rounds_half_cents_up(spark):
    sums = spark.createDataFrame(
        [(10681, None, 2, None), (-10681, None, 2, None), (100, None, 3, None), (None, None, 0, None), (100, "0.005", 2, None),
         (None, None, 1, float("nan"))],
        "p_cents bigint, other string, p_priced bigint, p_beyond double",
    ).selectExpr(
        "CAST(p_cents AS DECIMAL(28, 0)) AS p_cents", "CAST(other AS DECIMAL(36, 8)) AS p_other",
        "p_priced", "p_beyond",
    )
    totals = sums.withColumn("p_total", money.total_of(F.col("p_cents"), F.col("p_other")))
    got = totals.select(money.revenue("p"), money.average("p"))
    assert [tuple(map(plain, row)) for row in got.collect()] == [
        (106.81, 53.41), (-106.81, -53.41), (1.0, 0.33), (None, None), (1.01, 0.5), ("NaN", "NaN"),
    ]
