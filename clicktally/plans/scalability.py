"""Time the three questions on growing samples of one table."""

import time
from collections.abc import Callable, Sequence
from statistics import median

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.functions.events import with_event_date
from clicktally.operators.first_n import nth_smallest
from clicktally.plans.direct import daily_purchase_revenue, event_distribution, top_brands
from clicktally.sinks.results import write_result
from clicktally.sources.scratch import scratch_path, scratch_scope

SIZE_CLASS = "size_class"

# Sample sizes and column names of the timing table.
SAMPLE_SIZES = (100_000, 500_000, 1_000_000, 5_000_000)
TIMING_SCHEMA = """
    rows BIGINT,
    load_time_sec DOUBLE,
    event_distribution_sec DOUBLE,
    daily_purchase_revenue_sec DOUBLE,
    top10_brands_sec DOUBLE,
    total_analysis_time_sec DOUBLE,
    completed BOOLEAN
"""

# What a failure says when memory or an executor is gone: heap, container limit, kill, fetch failure.
OUT_OF_RESOURCES = ("OutOfMemory", "ExecutorLostFailure", "exit code 137", "exit status 137", "Container killed", "FetchFailed")

QUESTIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "event_distribution": event_distribution,
    "daily_purchase_revenue": daily_purchase_revenue,
    "top10_brands": top_brands,
}


def scalability_run(
    events: DataFrame,
    sizes: Sequence[int] = SAMPLE_SIZES,
    *,
    key: str,
    keys: DataFrame | None = None,
    repeats: int = 3,
    results_path: str | None = None,
) -> DataFrame:
    """One timing row per size, smallest first.

    Each sample is the first rows by ``key``, spread over the cluster and held in
    memory before the clock starts.  Times are medians over ``repeats`` runs;
    the smallest sample gets an untimed run first, so that no size pays for
    warming up.  Every size has a row: one that a failure of memory or of an
    executor ends has ``completed`` false, and the larger ones are tried all the
    same.  With ``results_path`` the answers of the largest completed sample are
    written there.

    ``events`` is read once, to stage the rows of all samples.  Finding where the
    samples end takes a few passes more over the key; ``keys`` may name a table
    that has the same keys and is cheaper to read, such as the events before a join.
    """
    sizes = sorted(sizes)
    cuts = nth_smallest(events if keys is None else keys, sizes, key)
    with scratch_scope(events.sparkSession):
        timings = _time_samples(events, sizes, cuts, key, repeats, results_path)
    return events.sparkSession.createDataFrame(timings, TIMING_SCHEMA)


def _time_samples(
    events: DataFrame, sizes: list[int], cuts: dict[int, int | None], key: str, repeats: int, results_path: str | None
) -> list[tuple]:
    staged = stage_samples(events, [cuts[size] for size in sizes], key)
    timings = []
    for place, size in enumerate(sizes):
        try:
            warm_up = not any(done for *_, done in timings)
            pool = staged.filter(F.col(SIZE_CLASS) <= place).drop(SIZE_CLASS)
            timings.append(_time_sample(pool, key, repeats, warm_up, results_path))
        except Exception as error:
            if not any(sign in str(error) for sign in OUT_OF_RESOURCES):
                raise
            timings.append((size, None, None, None, None, None, False))
    return timings


def stage_samples(events: DataFrame, cuts: Sequence[int | None], key: str) -> DataFrame:
    """The rows of the largest sample, stored in one folder for each ``size_class``: the place of the smallest
    sample that holds a row.  ``cuts`` are the last keys of the samples, rising, None for the whole table.

    A sample is the folders up to its own place, which a filter on the class selects without reading others.
    """
    narrow = with_event_date(events).select(key, "event_type", "event_date", "brand", "price")
    if cuts and cuts[-1] is not None:
        narrow = narrow.filter(F.col(key) <= F.lit(cuts[-1]))
    beyond = [(F.col(key) > F.lit(cut)).cast("int") for cut in cuts if cut is not None]
    classed = narrow.withColumn(SIZE_CLASS, sum(beyond, F.lit(0)))
    path = scratch_path(events.sparkSession, "samples")
    classed.write.partitionBy(SIZE_CLASS).parquet(path)
    return events.sparkSession.read.schema(classed.schema).parquet(path)


def _time_sample(
    pool: DataFrame, key: str, repeats: int, warm_up: bool, results_path: str | None
) -> tuple:
    sample, rows, load_time = load_sample(pool, key)
    try:
        if warm_up:
            for question in QUESTIONS.values():
                _run(question, sample)
        seconds = [
            median(_run(question, sample) for _ in range(repeats)) for question in QUESTIONS.values()
        ]
        if results_path:
            for name, question in QUESTIONS.items():
                write_result(question(sample), results_path, name, single_file=True)
    finally:
        sample.unpersist()
    return (rows, load_time, *seconds, sum(seconds), True)


def load_sample(pool: DataFrame, key: str) -> tuple[DataFrame, int, float]:
    """A cached sample, its row count and the seconds it took to fill the cache."""
    started = time.perf_counter()
    # The first rows sit in few file splits; hashing the unique key spreads them
    # over all cores.  The number is explicit because a cached shuffle is not merged.
    partitions = pool.sparkSession.sparkContext.defaultParallelism
    sample = pool.repartition(partitions, key).drop(key).persist(StorageLevel.MEMORY_AND_DISK)
    rows = sample.count()
    return sample, rows, time.perf_counter() - started


def _run(question: Callable[[DataFrame], DataFrame], sample: DataFrame) -> float:
    """Plan and execute a question without bringing rows to the driver."""
    started = time.perf_counter()
    question(sample).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def scalability_rows(events: DataFrame, sizes: Sequence[int], *, key: str) -> DataFrame:
    """Requested and actual rows per size: the run without its times.  Reads nothing but the key."""
    cuts = nth_smallest(events, sizes, key)
    inside = [
        F.count_if(F.lit(True) if cuts[size] is None else F.col(key) <= F.lit(cuts[size])).alias(f"n{i}")
        for i, size in enumerate(sorted(sizes))
    ]
    counted = events.select(key).agg(*inside)
    rows = F.array(
        *(F.struct(F.lit(size).cast("bigint").alias("requested_rows"), F.col(f"n{i}").alias("rows"))
          for i, size in enumerate(sorted(sizes)))
    )
    return counted.select(F.inline(rows)).withColumn("completed", F.lit(True))


def completed_runs(timings: DataFrame) -> DataFrame:
    return timings.filter(F.col("completed"))


def largest_completed(timings: DataFrame) -> DataFrame:
    return completed_runs(timings).agg(F.max("rows").alias("largest_rows"))
