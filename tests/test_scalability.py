"""The timed run on growing samples."""

import glob

import clicktally as ct
import pytest
from clicktally.jobs import report, scalability
from clicktally.jobs.options import job_session
from clicktally.plans import scalability as plan
from edge_rows import write_edge_file
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def events(spark):
    return spark.range(2000).select(
        F.col("id").alias("event_id"),
        F.concat(F.lit("2019-11-"), F.lpad((F.col("id") % 30 + 1).cast("string"), 2, "0")).alias("event_time"),
        F.when(F.col("id") % 5 == 0, "purchase").otherwise("view").alias("event_type"),
        F.concat(F.lit("b"), F.col("id") % 13).alias("brand"),
        (F.col("id") / 100).alias("price"),
    )


def test_rows_are_capped_at_the_table(events):
    table = ct.scalability_rows(events, [5000, 10, 500], key="event_id")
    assert [(r["requested_rows"], r["rows"]) for r in table.orderBy("requested_rows").collect()] == [
        (10, 10), (500, 500), (5000, 2000),
    ]
    assert ct.largest_completed(table).first()["largest_rows"] == 2000


def test_run_times_every_size_and_keeps_the_largest_answers(spark, events, tmp_path):
    timings = ct.scalability_run(events, [1000, 100], key="event_id", repeats=1, results_path=str(tmp_path))
    rows = timings.collect()
    assert [row["rows"] for row in rows] == [100, 1000]
    for row in rows:
        assert row["completed"]
        parts = [row[f"{name}_sec"] for name in plan.QUESTIONS]
        assert all(part > 0 for part in parts)
        assert row["total_analysis_time_sec"] == pytest.approx(sum(parts))
    expected = ct.event_distribution(ct.first_n(events, 1000, "event_id"))
    written = ct.read_result(spark, f"{tmp_path}/event_distribution", expected.schema)
    assert written.collect() == expected.collect()


@pytest.mark.parametrize("message", ["java.lang.OutOfMemoryError: Java heap space", "ExecutorLostFailure (exit code 137)"])
def test_a_size_that_fails_has_a_row_and_the_others_go_on(events, monkeypatch, message):
    original = plan.load_sample

    def fails_for_1000(pool, key):
        if pool.count() == 1000:
            raise RuntimeError(message)
        return original(pool, key)

    monkeypatch.setattr(plan, "load_sample", fails_for_1000)
    timings = ct.scalability_run(events, [100, 1000, 2000], key="event_id", repeats=1)
    assert [(row["rows"], row["completed"]) for row in timings.collect()] == [(100, True), (1000, False), (2000, True)]
    assert ct.completed_runs(timings).count() == 2
    assert ct.largest_completed(timings).first()["largest_rows"] == 2000


def test_samples_use_all_cores(spark, events):
    sample, rows, _ = plan.load_sample(events, "event_id")
    assert (sample.rdd.getNumPartitions(), rows) == (spark.sparkContext.defaultParallelism, 2000)
    sample.unpersist()


def test_other_errors_are_not_swallowed(events, monkeypatch):
    def broken(*_):
        raise RuntimeError("disk is gone")

    monkeypatch.setattr(plan, "load_sample", broken)
    with pytest.raises(RuntimeError, match="disk"):
        ct.scalability_run(events, [100], key="event_id", repeats=1)


def parts(folder):
    return glob.glob(f"{folder}/part-*.csv")


def test_report_job(spark, tmp_path, capsys):
    write_edge_file(tmp_path, "in/edge.csv")
    out = f"{tmp_path}/out"
    report.run(spark, [f"{tmp_path}/in/*.csv", out, "--valid-prices", "--findings", "--preview"])
    names = [
        "event_distribution", "daily_purchase_revenue", "top10_brands",
        "daily_purchase_revenue_valid", "top10_brands_valid", "conversion_rate", "missing_days",
        "missing_purchase_days", "daily_spikes", "typical_day", "brand_price_mix", "total_events", "stage_seconds",
    ]
    for name in names:
        assert len(parts(f"{out}/{name}")) == 1, name
    assert "81.82" in capsys.readouterr().out
    assert spark.read.csv(f"{out}/event_distribution", header=True).count() == 3


def test_report_job_reads_parquet(spark, tmp_path):
    ct.read_events_csv(spark, write_edge_file(tmp_path)).write.parquet(f"{tmp_path}/events")
    report.run(spark, [f"{tmp_path}/events", f"{tmp_path}/out", "--format", "parquet"])
    assert len(parts(f"{tmp_path}/out/top10_brands")) == 1


def test_scalability_job(spark, tmp_path):
    scalability.run(
        spark, [write_edge_file(tmp_path), f"{tmp_path}/out", "--sizes", "5", "20", "--repeats", "1"]
    )
    timings = spark.read.csv(f"{tmp_path}/out/timings", header=True, inferSchema=True).collect()
    assert [row["rows"] for row in timings] == [5, 11]
    assert len(parts(f"{tmp_path}/out/largest_sample/top10_brands")) == 1

    staged = f"{tmp_path}/out/staged"
    scalability.run(spark, [staged, f"{tmp_path}/again", "--format", "parquet", "--key", "row_id", "--sizes", "7", "--repeats", "1"])
    again = spark.read.csv(f"{tmp_path}/again/timings", header=True, inferSchema=True).collect()
    assert [row["rows"] for row in again] == [7]


def test_job_session_keeps_settings_the_caller_chose(spark):
    partitions = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    splits = "spark.sql.files.maxPartitionNum"
    spark.conf.set(partitions, "5")
    try:
        assert job_session("test").conf.get(partitions) == "5"
        assert spark.conf.get(splits) == "100000"
    finally:
        spark.conf.unset(partitions)
        spark.conf.unset(splits)


def test_options_that_would_do_nothing_are_rejected(spark, tmp_path):
    with pytest.raises(ValueError, match="CSV"):
        report.run(spark, [str(tmp_path), f"{tmp_path}/out", "--format", "parquet", "--recursive"])
    with pytest.raises(ValueError, match="--key"):
        scalability.run(spark, [str(tmp_path), f"{tmp_path}/out", "--key", "row_id"])
