"""Exact quantiles of counted values, however many values a group has."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktally.sources.scratch import scratch_path


def counted_quantiles(
    counts: DataFrame, group: str, value: str, count: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """``group``, the sum of its ``count``, and a column for each of ``quantiles``: the value below which that share
    of the group's rows lies, interpolated between neighbours as on the rows themselves.

    ``counts`` has one row for each group and ``value`` (a number that is neither NULL nor NaN) with the positive
    number of rows that have it; a NULL group gets no row.  All of it is sorted by group and value over the whole cluster.  A stretch of that
    order is summed up by one task; the sums before a stretch say which ranks its values have.  So a group is spread
    over as many tasks as its size asks for, and none holds all values of a group.
    """
    # Stored, so that both steps below see the same stretches, whatever executors come and go.
    dealt = counts.select(group, value, count).repartitionByRange(group, value).withColumn("part", F.spark_partition_id())
    path = scratch_path(counts.sparkSession, "sorted-counts")
    dealt.write.parquet(path)
    sorted_ = counts.sparkSession.read.schema(dealt.schema).parquet(path)
    stretch = [group, "part"]
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sorted_.groupBy(*stretch).agg(F.sum(count).alias("size"))
    # One row for each stretch of a group: no more than there are tasks.
    starts = sums.select(
        *stretch,
        F.coalesce(F.sum("size").over(before), F.lit(0).cast("bigint")).alias("start"),
        F.sum("size").over(Window.partitionBy(group)).alias("total"),
    )
    until = F.sum(count).over(Window.partitionBy(*stretch).orderBy(value))
    ranked = (
        sorted_.withColumn("until", until)
        .join(starts, stretch)
        .withColumn("last", F.col("start") + F.col("until") - 1)
        .withColumn("first", F.col("last") - F.col(count) + 1)
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(F.col("first"), F.col("last")), F.col(value)))

    measures = []
    for name, share in quantiles.items():
        place = (F.col("total") - 1) * F.lit(share)
        low, high = F.floor(place), F.ceil(place)
        part = F.max(place - low)
        measures.append((at(low) * (1 - part) + at(high) * part).alias(name))
    return ranked.groupBy(group).agg(F.max("total").alias(count), *measures)
