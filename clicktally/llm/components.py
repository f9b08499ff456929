"""Connected components of a link table, by alternating stars.

Every round replaces links by links to smaller numbers: first each node hands
its smallest neighbour to its larger neighbours, then each node gathers its
smaller neighbours under the smallest of them.  Both are a grouped minimum and
a join back to the links, so no task ever holds the neighbours of one node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.tables import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component_id``: the smallest node reachable over ``links`` (columns ``a``, ``b`` long).

    Nodes without a link to another node do not appear.  Links to itself,
    repeated links and NULL ends are ignored.
    """
    links = written(links.filter("a != b").select("a", "b").distinct(), "links")
    before = _state(links)
    while True:
        links = written(_small_star(_large_star(links)), "links")
        after = _state(links)
        if after == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
        before = after
