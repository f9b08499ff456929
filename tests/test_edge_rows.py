"""Expected answers for the edge rows, from the events and from the rollup."""

import datetime

import clicktally as ct
import pytest
from compare import plain
from edge_rows import write_edge_file

NOV_1 = datetime.date(2019, 11, 1)
NOV_2 = datetime.date(2019, 11, 2)


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    return ct.read_events_csv(spark, write_edge_file(tmp_path_factory.mktemp("edge"))).persist()


@pytest.fixture(scope="module")
def rollup(events):
    return ct.event_rollup(events).persist()


def rows(df):
    return [tuple(plain(value) for value in row) for row in df.collect()]


DISTRIBUTION = [("purchase", 9, 81.82), (None, 1, 9.09), ("Purchase", 1, 9.09)]
DAILY = [(None, 1, None, None), (NOV_1, 4, 70.01, 17.5), (NOV_2, 4, "NaN", "NaN")]
DAILY_VALID = [(NOV_1, 4, 70.01, 17.5), (NOV_2, 4, None, None)]
BRANDS = [("lg", "NaN", 4), ("   ", 20.0, 1), ("apple", 10.01, 1), ("sony", None, 1)]
BRANDS_VALID = [("apple", 10.01, 1, 10.01), ("lg", None, 4, None), ("sony", None, 1, None)]


def test_event_distribution(events, rollup):
    assert rows(ct.event_distribution(events)) == DISTRIBUTION
    assert rows(ct.event_distribution_from_rollup(rollup)) == DISTRIBUTION


def test_daily(events, rollup):
    assert rows(ct.daily_purchase_revenue(events)) == DAILY
    assert rows(ct.daily_purchase_revenue_from_rollup(rollup)) == DAILY


def test_daily_valid(events, rollup):
    columns = ["event_date", "num_purchase_events", "estimated_revenue", "avg_purchase_event_value"]
    assert rows(ct.valid_daily_revenue(events).select(*columns)) == DAILY_VALID
    assert rows(ct.valid_daily_revenue_from_rollup(rollup).select(*columns)) == DAILY_VALID


def test_brands(events, rollup):
    assert rows(ct.top_brands(events)) == BRANDS
    assert rows(ct.top_brands_from_rollup(rollup)) == BRANDS


def test_brands_valid(events, rollup):
    assert rows(ct.valid_top_brands(events)) == BRANDS_VALID
    assert rows(ct.valid_top_brands_from_rollup(rollup)) == BRANDS_VALID


def test_fewer_brands_on_request(events):
    assert rows(ct.top_brands(events, k=1)) == BRANDS[:1]


def test_total(events):
    assert rows(ct.total_events(events)) == [(11,)]


def test_empty_table_gives_no_rows(events):
    empty = events.limit(0)
    for question in (ct.event_distribution, ct.daily_purchase_revenue, ct.top_brands,
                     ct.valid_daily_revenue, ct.valid_top_brands, ct.event_rollup,
                     ct.missing_days, ct.brand_price_mix):
        assert rows(question(empty)) == []
    assert rows(ct.conversion_rate(empty)) == [(0, 0, None, None)]
    assert rows(ct.conversion_rate_from_rollup(ct.event_rollup(empty))) == [(0, 0, None, None)]


def test_equal_revenue_is_ordered_by_brand(spark):
    ties = spark.createDataFrame(
        [("purchase", brand, 5.0) for brand in "cab"], "event_type string, brand string, price double"
    )
    assert [row[0] for row in rows(ct.top_brands(ties, k=2))] == ["a", "b"]
