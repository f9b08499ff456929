"""Arguments and session settings the jobs share."""

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clicktally.sinks.versions import publish
from clicktally.sources.csv_events import read_events_csv
from clicktally.sources.parquet_events import read_events_parquet


def input_arguments(description: str) -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=description)
    parser.add_argument("input", help="event file, folder or glob")
    parser.add_argument("output", help="folder for the results")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv", help="format of the input")
    parser.add_argument("--recursive", action="store_true", help="search CSV files in all folders below")
    parser.add_argument("--file-name", help="glob that the names of CSV files must match")
    parser.add_argument("--preview", action="store_true", help="also print the results")
    parser.add_argument("--versions", action="store_true", help="write into a new folder of OUTPUT, which a pointer names once it is complete")
    return parser


def run_into(spark: SparkSession, args: argparse.Namespace, write: Callable[[str], object]) -> str:
    """Let ``write`` fill the output folder or, with ``--versions``, a version of it; that folder."""
    base = args.output.rstrip("/")
    if args.versions:
        return publish(spark, base, write)
    write(base)
    return base


def read_input(spark: SparkSession, args: argparse.Namespace, keep_rejected: bool = False) -> DataFrame:
    if args.format == "parquet":
        if keep_rejected:
            raise ValueError("--count-rejected is for CSV input")
        if args.recursive or args.file_name:
            raise ValueError("--recursive and --file-name are for CSV input")
        return read_events_parquet(spark, args.input)
    return read_events_csv(spark, args.input, recursive=args.recursive, file_name=args.file_name, keep_rejected=keep_rejected)


def job_session(name: str) -> SparkSession:
    """The session of spark-submit, with defaults for large input where the caller set none."""
    spark = SparkSession.builder.appName(name).getOrCreate()
    chosen = int(spark.conf.get("spark.sql.shuffle.partitions"))
    defaults = {
        # Adaptive execution merges small partitions but splits none, so start with plenty: two for each core.
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": max(
            chosen, 2 * spark.sparkContext.defaultParallelism
        ),
        # Makes the splits of a very large input bigger instead of more numerous.
        "spark.sql.files.maxPartitionNum": 100_000,
    }
    for setting, value in defaults.items():
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, str(value))
    return spark
