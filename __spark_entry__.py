"""The queries this repository offers, each over the driver's parquet tables."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import clicktally as ct  # noqa: E402
import duckdb_oracles  # noqa: E402
from clicktally.functions.events import (  # noqa: E402
    event_date,
    event_date_text,
    has_brand,
    has_nonblank_brand,
    is_purchase,
    valid_price,
    with_event_date,
)
from clicktally.jobs import report, scalability  # noqa: E402
from clicktally.schema import event_columns  # noqa: E402
from clicktally.plans.rollup import write_rollup  # noqa: E402
from clicktally.plans.scalability import TIMING_SCHEMA  # noqa: E402
from clicktally.sinks.results import LOSSLESS  # noqa: E402
from clicktally.sources.csv_events import REJECT_COLUMN  # noqa: E402
from clicktally.sources.scratch import scratch_path  # noqa: E402
from clicktally.sources.star_tables import damaged, read_clickstream, read_star_events  # noqa: E402

try:
    from clicktally.llm import queries as corpus_queries
except ImportError as missing:
    if not (missing.name or "").startswith("clicktally.llm"):
        raise
    corpus_queries = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_FOLDER = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """The ten brands with the largest purchase revenue."""
    return ct.top_brands(read_clickstream(spark, SMOKE_FOLDER))


def _events(question: Callable[[DataFrame], DataFrame]) -> Query:
    """A question that needs no brand, so the brand join is left out."""
    return lambda spark, folder: question(read_star_events(spark, folder))


def _clean(question: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: question(read_clickstream(spark, folder))


def _dirty(question: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: question(damaged(read_clickstream(spark, folder)))


def _dirty_events(question: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: question(damaged(read_star_events(spark, folder)))


def _clean_rollup(question: Callable[[DataFrame], DataFrame]) -> Query:
    return _clean(lambda events: question(ct.event_rollup(events)))


def _dirty_rollup(question: Callable[[DataFrame], DataFrame]) -> Query:
    return _dirty(lambda events: question(ct.event_rollup(events)))


def _as_event_file(clickstream: DataFrame) -> DataFrame:
    return clickstream.select(*event_columns())


def _written_csv(events: DataFrame, name: str) -> str:
    path = scratch_path(events.sparkSession, name)
    _as_event_file(events).write.csv(path, header=True, **LOSSLESS)
    return path


def _csv_round_trip(question: Callable[[DataFrame], DataFrame]) -> Query:
    """All nine columns, written and read again."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = _written_csv(question(read_clickstream(spark, folder)), "events-csv")
        return ct.require_columns(ct.read_events_csv(spark, path))

    return query


def _recursive_csv_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in one folder per day, found by a recursive search for a file name."""
    path = scratch_path(spark, "events-by-day")
    events = with_event_date(_as_event_file(read_clickstream(spark, folder)))
    # A day goes to a few tasks, however large it is, and a task writes a few days.
    salt = F.pmod(F.xxhash64("user_session", "event_time"), F.lit(4))
    events.repartition("event_date", salt).write.partitionBy("event_date").csv(path, header=True, **LOSSLESS)
    found = ct.read_events_csv(spark, path, recursive=True, file_name="part-*.csv")
    return (
        with_event_date(found)
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("events"), F.count("brand").alias("branded"))
    )


def _csv_with_bad_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """The product number of every 37th event is replaced by text that is no number."""
    events = damaged(read_clickstream(spark, folder))
    bad = F.when(F.col("event_id") % 37 == 0, "x").otherwise(F.col("product_id").cast("string"))
    path = _written_csv(events.withColumn("product_id", bad), "events-with-bad-numbers")
    return ct.read_events_csv(spark, path, keep_rejected=True)


def _csv_rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ct.rejected_rows(_csv_with_bad_numbers(spark, folder))


def _csv_rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of the lines that held bad text, and where in the line it was."""
    lines = _csv_with_bad_numbers(spark, folder).filter(F.col(REJECT_COLUMN).isNotNull())
    return lines.select(
        "event_time", "user_id", "product_id", F.split(REJECT_COLUMN, ",")[2].alias("product_text")
    )


def _result_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every brand of the damaged rows, blank and spaced ones too, as written and read again."""
    events = damaged(read_clickstream(spark, folder))
    spaced = F.when(F.col("event_id") % 20 == 3, F.concat(F.lit(" "), "brand", F.lit(" "))).otherwise(F.col("brand"))
    counts = events.withColumn("brand", spaced).groupBy("brand").agg(F.count(F.lit(1)).alias("events"), F.max("event_time").alias("last_time"))
    path = ct.write_result(counts, scratch_path(spark, "results"), "brands")
    return ct.read_result(spark, path, counts.schema)


def _staged_events(spark: SparkSession, folder: str) -> DataFrame:
    """The staged table with its rows counted in the order of their numbers, events going in by number."""
    events = read_clickstream(spark, folder).repartitionByRange("event_id").sortWithinPartitions("event_id")
    staged = ct.stage_events(events, scratch_path(spark, "staged"))
    in_order = Window.partitionBy("event_date").orderBy("row_id")
    return staged.withColumn("place_in_day", F.row_number().over(in_order)).drop("row_id")


def _events_in_three_files(spark: SparkSession, folder: str) -> str:
    """One event, then fifty, then all others, in folders whose names give that order; each by event number."""
    place = F.when(F.col("event_id") < 1, "a").when(F.col("event_id") < 51, "b").otherwise("c")
    events = read_clickstream(spark, folder).withColumn("part", place)
    path = scratch_path(spark, "events-in-three-files")
    order = ["part", "event_id"]
    in_order = events.repartitionByRange(*order).sortWithinPartitions(*order)
    in_order.select("part", *event_columns()).write.partitionBy("part").csv(path, header=True, **LOSSLESS)
    return path


def _staged_in_file_order(spark: SparkSession, folder: str) -> DataFrame:
    """The numbers of the rows of several files, the largest of which comes last."""
    path = _events_in_three_files(spark, folder)
    events = ct.read_events_csv(spark, f"{path}/part=*/*.csv")
    return ct.stage_events(events, scratch_path(spark, "staged"), file_order=True)


def _growing_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Counted in three steps, file by file; the last step finds nothing new."""
    path, base = _events_in_three_files(spark, folder), scratch_path(spark, "growing-rollup")
    for part in ("b", "*", "*"):
        rollup = ct.update_rollup(spark, base, f"{path}/part={part}/*.csv")
    return rollup


def _report_input_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What the report job says about its input, from the pass that made its rollup."""
    events = damaged(read_clickstream(spark, folder))
    bad = F.when(F.col("event_id") % 37 == 0, "x").otherwise(F.col("product_id").cast("string"))
    path = _written_csv(events.withColumn("product_id", bad), "events-with-bad-numbers")
    base = scratch_path(spark, "report")
    report.run(spark, [path, base, "--count-rejected", "--versions"])
    columns = T.StructType().add("total_rows", "long").add("rejected_rows", "long")
    return ct.read_result(spark, f"{ct.current_version(spark, base)}/input_rows", columns)


def _stored_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Written twice: the second one replaces the first."""
    path = scratch_path(spark, "rollup")
    events = read_clickstream(spark, folder)
    write_rollup(events, path)
    return write_rollup(events, path)


def _sizes(events: DataFrame) -> list[int]:
    """1, 10, 50, 100 and 200 percent of the table."""
    total = events.count()
    return [total * percent // 100 for percent in (1, 10, 50, 100, 200)]


def _scalability_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = read_star_events(spark, folder)
    return ct.scalability_rows(events, _sizes(events), key="event_id")


def _scalability_run(spark: SparkSession, folder: str) -> DataFrame:
    """The timed run without its times, the same on every machine."""
    keys = read_star_events(spark, folder)
    timings = ct.scalability_run(read_clickstream(spark, folder), _sizes(keys), key="event_id", keys=keys, repeats=1)
    seconds = [name for name in timings.columns if name.endswith("_sec")]
    return timings.select(
        "rows", "completed", F.array_min(F.array(*[F.col(name) > 0 for name in seconds])).alias("timed")
    )


def _timing_table(spark: SparkSession, folder: str) -> DataFrame:
    """The table of timings as the job writes it, without the times."""
    events, base = scratch_path(spark, "timed-events"), scratch_path(spark, "timings")
    narrow = with_event_date(read_clickstream(spark, folder)).select("event_id", "event_type", "event_date", "brand", "price")
    narrow.write.parquet(events)
    sizes = map(str, _sizes(read_star_events(spark, folder)))
    scalability.run(spark, [events, base, "--format", "parquet", "--key", "event_id", "--repeats", "1", "--sizes", *sizes])
    timings = ct.read_result(spark, f"{base}/timings", T.StructType.fromDDL(TIMING_SCHEMA))
    return timings.select("rows", "completed", (F.col("total_analysis_time_sec") > 0).alias("timed"))


def _whole_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The sizes that the table could fill: those it could not count as not completed."""
    table = _scalability_rows(spark, folder)
    return ct.completed_runs(table.withColumn("completed", F.col("rows") == F.col("requested_rows")))


def _largest_sample(name: str, question: Callable[[DataFrame], DataFrame]) -> Query:
    """An answer that the timed run wrote for its largest sample."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        base = scratch_path(spark, "largest-sample")
        events, keys = read_clickstream(spark, folder), read_star_events(spark, folder)
        half = keys.count() // 2
        ct.scalability_run(events, [half // 10, half], key="event_id", keys=keys, repeats=1, results_path=base)
        return ct.read_result(spark, f"{base}/{name}", question(events).schema)

    return query


def _days_without_purchase(events: DataFrame) -> DataFrame:
    return ct.missing_days(events.filter(is_purchase() & has_brand()), "brand")


def event_queries() -> dict[str, Query]:
    """The queries of the library itself."""
    return {
        # The three questions.
        "event_distribution": _events(ct.event_distribution),
        "daily_purchase_revenue": _events(ct.daily_purchase_revenue),
        "top10_brands": _clean(ct.top_brands),
        # Their edge rules, on damaged rows.
        "event_distribution_nulls": _dirty_events(ct.event_distribution),
        "daily_purchase_revenue_valid": _dirty_events(ct.valid_daily_revenue),
        "top10_brands_valid": _dirty(ct.valid_top_brands),
        # Single projections and filters.
        "event_date_projection": _dirty_events(
            lambda e: e.select(
                "event_id",
                event_date_text().alias("event_date_text"),
                event_date().alias("event_date"),
            )
        ),
        "valid_price_projection": _dirty_events(
            lambda e: e.select("event_id", "price", valid_price().alias("valid_price"))
        ),
        "purchase_filter": _dirty_events(
            lambda e: e.filter(is_purchase()).select("event_id", "event_time", "event_type", "price")
        ),
        "branded_filter": _dirty(
            lambda e: e.filter(has_brand()).select("event_id", "brand", "price")
        ),
        "nonblank_brand_filter": _dirty(
            lambda e: e.filter(has_nonblank_brand()).select("event_id", "brand", "price")
        ),
        "total_events": _events(ct.total_events),
        "clickstream_view": _clean(lambda e: e),
        "damaged_clickstream_view": _dirty(lambda e: e),
        # First rows by key.
        "first_n_event_distribution": _events(
            lambda e: ct.event_distribution(ct.first_n(e, 500, "event_id"))
        ),
        # Everything again from one pass.
        "event_rollup": _clean(ct.event_rollup),
        "event_rollup_damaged": _dirty(ct.event_rollup),
        "q1_from_rollup": _clean_rollup(ct.event_distribution_from_rollup),
        "q2_from_rollup": _clean_rollup(ct.daily_purchase_revenue_from_rollup),
        "q3_from_rollup": _clean_rollup(ct.top_brands_from_rollup),
        "valid_daily_from_rollup": _dirty_rollup(ct.valid_daily_revenue_from_rollup),
        "valid_top10_brands_from_rollup": _dirty_rollup(ct.valid_top_brands_from_rollup),
        "conversion_rate_from_rollup": _clean_rollup(ct.conversion_rate_from_rollup),
        "brand_price_mix_from_rollup": _clean_rollup(ct.brand_price_mix_from_rollup),
        # Sources and sinks.
        "csv_round_trip": _csv_round_trip(lambda e: e),
        "csv_round_trip_damaged": _csv_round_trip(damaged),
        "recursive_csv_events": _recursive_csv_events,
        "csv_rejected_rows": _csv_rejected_rows,
        "csv_rejected_lines": _csv_rejected_lines,
        "result_round_trip": _result_round_trip,
        "staged_events": _staged_events,
        "staged_in_file_order": _staged_in_file_order,
        "stored_rollup": _stored_rollup,
        "growing_rollup": _growing_rollup,
        "report_input_rows": _report_input_rows,
        "daily_purchase_revenue_damaged": _dirty_events(ct.daily_purchase_revenue),
        # Scalability.
        "scalability_rows": _scalability_rows,
        "largest_completed": lambda spark, folder: ct.largest_completed(
            _scalability_rows(spark, folder)
        ),
        "whole_samples": _whole_samples,
        "largest_whole_sample": lambda spark, folder: ct.largest_completed(_whole_samples(spark, folder)),
        "scalability_run": _scalability_run,
        "timing_table": _timing_table,
        "largest_sample": _largest_sample("daily_purchase_revenue", ct.daily_purchase_revenue),
        "largest_sample_distribution": _largest_sample("event_distribution", ct.event_distribution),
        "largest_sample_top10_brands": _largest_sample("top10_brands", ct.top_brands),
        # Findings.
        "conversion_rate": _events(ct.conversion_rate),
        "missing_days": _events(ct.missing_days),
        "missing_days_by_brand": _clean(_days_without_purchase),
        "daily_spikes": _events(lambda e: ct.daily_spikes(ct.daily_purchase_revenue(e), 1.1)),
        "typical_day": _events(lambda e: ct.typical_day(ct.daily_purchase_revenue(e))),
        "brand_price_mix": _clean(ct.brand_price_mix),
        "brand_price_quartiles": _clean(lambda e: ct.brand_price_quartiles(ct.price_counts(e))),
        "brand_price_quartiles_damaged": _dirty(lambda e: ct.brand_price_quartiles(ct.price_counts(e))),
    }


def queries() -> dict[str, Query]:
    return event_queries() | (corpus_queries.queries() if corpus_queries else {})


def oracle_sql() -> dict[str, str]:
    """The same queries for DuckDB, where SQL can express them."""
    return duckdb_oracles.oracle_sql() | (corpus_queries.oracle_sql() if corpus_queries else {})
