"""Time the three questions on growing samples of one event table.

    spark-submit --py-files clicktally.zip clicktally/jobs/scalability.py INPUT OUTPUT

The input is numbered in the order of its files and lines and staged as narrow Parquet below
OUTPUT/staged.  With ``--key`` the input already carries a unique integer
column to order by, for instance a table staged before, and nothing is staged.
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from clicktally.functions.events import with_event_date
from clicktally.jobs.options import input_arguments, job_session, read_input, run_into
from clicktally.operators.checks import require_columns
from clicktally.plans.scalability import SAMPLE_SIZES, scalability_run
from clicktally.sinks.results import write_result
from clicktally.sources.parquet_events import ROW_ID, stage_events


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> None:
    parser = input_arguments("Seconds per question at growing numbers of rows.")
    parser.add_argument("--sizes", type=int, nargs="+", default=list(SAMPLE_SIZES))
    parser.add_argument("--repeats", type=int, default=3, help="timed runs per question")
    parser.add_argument("--key", help="unique integer column of a Parquet input that orders its rows")
    args = parser.parse_args(argv)

    run_into(spark, args, lambda base: _write(spark, args, base))


def _write(spark: SparkSession, args: argparse.Namespace, base: str) -> None:
    if args.key:
        if args.format != "parquet":
            raise ValueError("--key needs --format parquet")
        table = require_columns(
            with_event_date(spark.read.parquet(args.input)), [args.key, "event_type", "event_date", "brand", "price"]
        )
    else:
        table = stage_events(read_input(spark, args), f"{base}/staged", file_order=True)
    timings = scalability_run(
        table,
        args.sizes,
        key=args.key or ROW_ID,
        repeats=args.repeats,
        results_path=f"{base}/largest_sample",
    )
    write_result(timings, base, "timings", single_file=True, preview_rows=len(args.sizes) if args.preview else 0)


if __name__ == "__main__":
    session = job_session("clicktally scalability")
    run(session)
    session.stop()
