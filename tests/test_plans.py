"""The physical plans: one scan, pruned columns, pushed filters, partial aggregation."""

import re

import __spark_entry__ as entries
import clicktally as ct
import pytest
from clicktally.sources.scratch import scratch_path
from edge_rows import write_edge_file
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Edge rows as a Parquet event table with all nine columns."""
    path = scratch_path(spark, "plan-events")
    csv = write_edge_file(tmp_path_factory.mktemp("plans"))
    ct.read_events_csv(spark, csv).write.parquet(path)
    return ct.read_events_parquet(spark, path)


def executed_plan(df, capsys):
    """The plan as it ran, without the initial plans that adaptive execution prints beside it."""
    df.collect()
    capsys.readouterr()
    df.explain()
    kept, hidden_below = [], None
    for line in capsys.readouterr().out.splitlines():
        indent = len(line) - len(line.lstrip(" :"))
        if hidden_below is not None and indent > hidden_below:
            continue
        hidden_below = indent if "== Initial Plan ==" in line else None
        if hidden_below is None:
            kept.append(line)
    return "\n".join(kept)


def read_columns(plan):
    return [set(re.findall(r"(\w+):\w+", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def test_distribution_scans_once(events, capsys):
    plan = executed_plan(ct.event_distribution(events), capsys)
    assert read_columns(plan) == [{"event_type"}]


def test_distribution_of_a_cached_partition_groups_once(spark, events, capsys):
    sample = events.coalesce(1).persist()
    try:
        plan = executed_plan(ct.event_distribution(sample), capsys)
    finally:
        sample.unpersist()
    assert plan.count("InMemoryTableScan") == 1


def test_samples_are_cut_before_the_brand_join(spark, capsys):
    """Finding the cut-offs of all sizes together reads the key, and what the join needs."""
    clickstream = entries.read_clickstream(spark, FOLDER)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("cuts", "cuts")
    try:
        table = ct.scalability_rows(clickstream, [10, 100, 500, 1000], key="event_id")
        plan = executed_plan(table, capsys)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("cuts")) < 15
    assert all(columns <= {"event_id", "p_partkey", "props"} for columns in read_columns(plan))


def test_cut_offs_join_nothing(spark, capsys, monkeypatch):
    """With a table of keys the passes that find the cut-offs read one column and have no join; the joined events are
    read once, for all samples."""
    from clicktally.plans import scalability

    keys = entries.read_star_events(spark, FOLDER)
    plan = executed_plan(ct.scalability_rows(keys, [10, 100, 500, 1000], key="event_id"), capsys)
    assert "Join" not in plan and read_columns(plan) == [{"event_id"}]

    staged, original = [], scalability.stage_samples
    monkeypatch.setattr(scalability, "stage_samples", lambda *a: staged.append(original(*a)) or staged[-1])
    pools, load = [], scalability.load_sample

    def seen(pool, key):
        pool.explain()
        pools.append(capsys.readouterr().out)
        return load(pool, key)

    monkeypatch.setattr(scalability, "load_sample", seen)
    timings = ct.scalability_run(entries.read_clickstream(spark, FOLDER), [100, 1000], key="event_id", keys=keys, repeats=1)
    assert [row["rows"] for row in timings.collect()] == [100, 1000]
    assert len(staged) == 1 and len(pools) == 2
    assert all("Join" not in pool and "PartitionFilters: [isnotnull(size_class" in pool for pool in pools)


def test_daily_pushes_its_filter_and_reads_three_columns(events, capsys):
    plan = executed_plan(ct.daily_purchase_revenue(events), capsys)
    assert read_columns(plan) == [{"event_time", "event_type", "price"}]
    assert "EqualTo(event_type,purchase)" in plan


def test_brands_push_both_filters_and_keep_only_ten_rows(events, capsys):
    plan = executed_plan(ct.top_brands(events), capsys)
    assert read_columns(plan) == [{"brand", "event_type", "price"}]
    assert "EqualTo(event_type,purchase)" in plan
    assert "IsNotNull(brand)" in plan
    assert "TakeOrderedAndProject(limit=10" in plan


def test_rollup_is_one_scan_and_one_shuffle(events, capsys):
    plan = executed_plan(ct.event_rollup(events), capsys)
    assert read_columns(plan) == [{"event_time", "event_type", "brand", "price"}]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum(" in plan


def test_missing_days_reads_one_column_once(events, capsys):
    plan = executed_plan(ct.missing_days(events), capsys)
    assert read_columns(plan) == [{"event_time"}]


def test_spikes_scan_once(events, capsys):
    plan = executed_plan(ct.daily_spikes(ct.daily_purchase_revenue(events)), capsys)
    assert len(read_columns(plan)) == 1


def test_first_n_pushes_its_cutoff(spark, capsys):
    path = scratch_path(spark, "plan-keys")
    spark.range(1000).write.parquet(path)
    plan = executed_plan(ct.first_n(spark.read.parquet(path), 10, "id"), capsys)
    assert "LessThanOrEqual(id,9)" in plan
    assert "Limit" not in plan


@pytest.mark.parametrize("name", sorted(entries.event_queries()))
def test_no_python_and_no_cartesian_product(spark, capsys, name):
    plan = executed_plan(entries.event_queries()[name](spark, FOLDER), capsys)
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_brand_join_without_broadcast_splits_skewed_products(spark, capsys):
    """With the small side above the size limit the join shuffles instead of broadcasting."""
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed_plan(entries.event_queries()["event_rollup"](spark, FOLDER), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert "BroadcastHashJoin" not in plan
    assert "SortMergeJoin" in plan
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_one_brand_with_a_third_of_the_rows(spark, capsys):
    """Rows are added up before the shuffle, so the hot brand travels as a few partial sums."""
    n = 300_000
    hot = spark.range(0, n, numPartitions=8).select(
        F.lit("purchase").alias("event_type"),
        F.lit("2019-11-01 x").alias("event_time"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 1000)).alias("brand"),
        F.lit(0.01).alias("price"),
    )
    rollup = ct.event_rollup(hot)
    top = ct.top_brands_from_rollup(rollup, k=1).first()
    assert (top["brand"], top["estimated_revenue"], top["num_purchases"]) == ("hot", n / 300, n // 3)
    assert "partial_count" in executed_plan(rollup, capsys)
