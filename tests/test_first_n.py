"""First rows by key against plain sorting."""

import clicktally as ct
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

BIGINT = st.integers(min_value=-(2**63), max_value=2**63 - 1)


def keys_of(df):
    return sorted(row[0] for row in df.collect())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(BIGINT, unique=True, min_size=1, max_size=60), data=st.data())
def test_matches_sorting(spark, keys, data):
    n = data.draw(st.integers(min_value=0, max_value=len(keys) + 2))
    df = spark.createDataFrame([(key,) for key in keys], "k bigint")
    assert keys_of(ct.first_n(df, n, "k")) == sorted(keys)[:n]


@pytest.mark.parametrize("n", [1, 499, 500, 33_333, 99_999, 100_000, 100_001])
def test_dense_keys(spark, n):
    df = spark.range(100_000).withColumnRenamed("id", "k")
    assert ct.first_n(df, n, "k").count() == min(n, 100_000)


def test_crowded_keys(spark):
    """A third of the keys crowds into one narrow range far from the others."""
    crowd = [10**15 + i for i in range(1000)]
    df = spark.createDataFrame([(k,) for k in [*range(0, 2 * 10**18, 10**15), *crowd[1:]]], "k bigint")
    everything = keys_of(df)
    for n in (2, 3, 500, 1001, 1500):
        assert keys_of(ct.first_n(df, n, "k")) == everything[:n]


def test_small_integer_types(spark):
    df = spark.createDataFrame([(k,) for k in range(-50, 50)], "k int")
    assert keys_of(ct.first_n(df, 60, "k")) == list(range(-50, 10))


def test_keeps_partitions(spark):
    df = spark.range(0, 10_000, numPartitions=8).withColumnRenamed("id", "k")
    assert ct.first_n(df, 9_000, "k").rdd.getNumPartitions() == 8


def test_rejects_unfit_keys(spark):
    with pytest.raises(ValueError, match="integer"):
        ct.first_n(spark.createDataFrame([("a",), ("b",)], "k string"), 1, "k")
    with pytest.raises(ValueError, match="NULL"):
        ct.first_n(spark.createDataFrame([(1,), (None,)], "k bigint"), 1, "k")
    with pytest.raises(ValueError, match="unique"):
        ct.first_n(spark.createDataFrame([(1,), (1,), (2,)], "k bigint"), 1, "k")
