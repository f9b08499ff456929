"""Answer all questions about one event table.

    spark-submit --py-files clicktally.zip clicktally/jobs/report.py INPUT OUTPUT

Reads the input once into OUTPUT/event_rollup (Parquet); every result folder
is then computed from that table.  OUTPUT/stage_seconds has the time of each step.

``--count-rejected`` adds OUTPUT/input_rows: how many lines there were and how
many held a field that did not parse.  The same pass counts them, but it has to
parse all nine columns instead of four.  With ``--versions`` a run fills a folder
of its own below OUTPUT, and readers that follow OUTPUT/CURRENT see the results
of one whole run or of the one before, never of two.
"""

import argparse
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from clicktally.jobs.options import input_arguments, job_session, read_input, run_into
from clicktally.plans import findings, rollup
from clicktally.sinks.results import write_result

# Results with a row for every brand keep their partitions.
PER_BRAND = {"brand_price_mix"}


def results(table: DataFrame, valid: bool, extras: bool, rejected: bool = False) -> dict[str, DataFrame]:
    daily = rollup.daily_purchase_revenue_from_rollup(table)
    answers = {
        "total_events": rollup.total_events_from_rollup(table),
        "event_distribution": rollup.event_distribution_from_rollup(table),
        "daily_purchase_revenue": daily,
        "top10_brands": rollup.top_brands_from_rollup(table),
    }
    if rejected:
        answers["input_rows"] = rollup.rejected_rows_from_rollup(table)
    if valid:
        answers["daily_purchase_revenue_valid"] = rollup.valid_daily_revenue_from_rollup(table)
        answers["top10_brands_valid"] = rollup.valid_top_brands_from_rollup(table)
    if extras:
        answers["conversion_rate"] = rollup.conversion_rate_from_rollup(table)
        answers["missing_days"] = findings.missing_days(table)
        answers["missing_purchase_days"] = findings.missing_days(daily)
        answers["daily_spikes"] = findings.daily_spikes(daily)
        answers["typical_day"] = findings.typical_day(daily)
        answers["brand_price_mix"] = rollup.brand_price_mix_from_rollup(table)
    return answers


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> None:
    parser = input_arguments("Event distribution, daily revenue and top brands.")
    parser.add_argument("--valid-prices", action="store_true", help="add the valid-price variants")
    parser.add_argument("--findings", action="store_true", help="add conversion, gaps, spikes, price mix")
    parser.add_argument("--count-rejected", action="store_true", help="add the number of lines that did not parse")
    args = parser.parse_args(argv)
    run_into(spark, args, lambda base: _write(spark, args, base))


def _write(spark: SparkSession, args: argparse.Namespace, base: str) -> None:
    stages = []

    def timed(name: str, action):
        started = time.perf_counter()
        out = action()
        stages.append((name, time.perf_counter() - started))
        return out

    events = read_input(spark, args, keep_rejected=args.count_rejected)
    table = timed("event_rollup", lambda: rollup.write_rollup(events, f"{base}/event_rollup"))
    for name, result in results(table, args.valid_prices, args.findings, args.count_rejected).items():
        timed(name, lambda: write_result(  # noqa: B023
            result, base, name, preview_rows=31 if args.preview else 0, single_file=name not in PER_BRAND  # noqa: B023
        ))
    seconds = spark.createDataFrame(stages, "stage string, seconds double").coalesce(1)
    write_result(seconds, base, "stage_seconds", preview_rows=len(stages) if args.preview else 0, single_file=True)


if __name__ == "__main__":
    session = job_session("clicktally report")
    run(session)
    session.stop()
