"""A training mix of sources in target proportions, by Poisson replication.

The repetition rate of a source is its target share of all code points over
its own share.  A document gets a Poisson number of copies with that mean: the
distribution is inverted at a uniform number made from a hash of the seed and
the document, so a run always repeats itself and no document waits for
another.  The copies are dealt out by a second hash and sorted by it: a global
shuffle.  The documents of a source, however many, go to all tasks.

Defined results: NULL is a source like any other.  An empty text counts as one
code point in the size of its source.  A row without a number, or with one that
another row has too, draws by a hash of all its columns and by its place among
rows equal in all of them, so each such row draws for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktally.llm.tables import written

#: Largest mean of one Poisson step.  Larger means are sums of several steps, so exp() never underflows.
_STEP = 16.0
#: Values of one step: beyond 80 the probability at mean 16 is below 2^-53.
_VALUES = 80
#: Equal rows counted together.
_RUN = 4096


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _poisson(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... at a mean of at most ``_STEP``."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_VALUES)),
        F.array(F.struct(F.exp(-rate).alias("term"), F.exp(-rate).alias("up_to"))),
        lambda done, k: F.concat(
            done,
            F.array(
                F.struct(
                    (F.element_at(done, -1)["term"] * rate / k).alias("term"),
                    (F.element_at(done, -1)["up_to"] + F.element_at(done, -1)["term"] * rate / k).alias("up_to"),
                )
            ),
        ),
        lambda done: F.transform(done, lambda x: x["up_to"]),
    )


def source_rates(
    docs: DataFrame, target_weights: dict[str, float] | None, source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """``source``, ``rate``: mean copies of a document of each source.

    Without weights a source weighs the square root of its code points, which
    lifts small sources.  Sources that given weights leave out have rate 0.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.greatest(F.char_length(F.coalesce(F.col(text_col), F.lit(""))), F.lit(1))).cast("long").alias("size")
    )
    if target_weights is None:
        weight = F.floor(F.sqrt(F.col("size").cast("double")) * 1000).cast("long")
    else:
        weight = F.lit(0.0)
        for source, share in target_weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(share))).otherwise(weight)
    sizes = written(sizes.withColumn("weight", weight), "source-sizes")
    all_size, all_weight = sizes.agg(F.sum("size"), F.sum("weight")).first()
    return sizes.select(
        "source",
        (F.col("weight") * F.lit(float(all_size or 0)) / (F.lit(float(all_weight or 1)) * F.col("size"))).alias("rate"),
    )


def _numbered(named: DataFrame) -> DataFrame:
    """The rows with an ``id`` of their own, made of their contents and their place among equal rows.

    Equal rows are counted in runs of at most ``_RUN`` within a partition, and
    the runs are then put one after another, so no task holds all equal rows.
    """
    held = written(
        named.select(
            "row", "own_source", F.md5(F.to_json("row").cast("binary")).alias("same"),
            F.monotonically_increasing_id().alias("seq"),
        ).withColumn("run", F.expr(f"seq div {_RUN}")),
        "rows-without-own-number",
    )
    runs = written(held.groupBy("same", "run").agg(F.count(F.lit(1)).alias("n")), "runs-of-equal-rows")
    earlier = Window.partitionBy("same").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("same", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("same", "run").orderBy("seq"))
    return held.withColumn("nth", within).join(runs, ["same", "run"]).select(
        "row", "own_source", F.concat_ws("/", "same", (F.col("before") + F.col("nth")).cast("string")).alias("id")
    )


def mixed(
    docs: DataFrame,
    target_weights: dict[str, float] | None = None,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``row`` (the whole row of ``docs``), ``copy`` (from 1) and ``place``, in the order of ``place``."""
    rates = source_rates(docs, target_weights, source_col, text_col)
    # A written table has a known size: Spark broadcasts it only if it is small, and else splits large sources.
    steps = written(rates.withColumn("steps", F.greatest(F.ceil(F.col("rate") / _STEP), F.lit(1)).cast("int")).select(
        F.col("source").alias("rate_source"), "steps", _poisson(F.col("rate") / F.col("steps")).alias("up_to")
    ), "source-steps")
    named = docs.select(
        F.struct("*").alias("row"), F.col(source_col).alias("own_source"), F.col(id_col).cast("long").alias("number")
    )
    given = named.filter("number is not null")
    repeated = written(given.groupBy("number").count().filter("count > 1").select("number"), "repeated-numbers")
    unclear = named.filter("number is null").unionByName(given.join(repeated, "number", "left_semi").select(*named.columns))
    packed = (
        given.join(repeated, "number", "left_anti")
        .select("row", "own_source", F.col("number").cast("string").alias("id"))
        .unionByName(_numbered(unclear))
    )
    draws = F.transform(
        F.sequence(F.lit(1), F.col("steps")),
        lambda step: _uniform(F.lit(f"{seed}"), F.lit("copies"), step.cast("string"), F.col("id")),
    )
    drawn = (
        packed.join(steps, F.col("own_source").eqNullSafe(F.col("rate_source")))
        .withColumn("draws", draws)
        .withColumn(
            "copies",
            F.aggregate("draws", F.lit(0), lambda total, u: total + F.size(F.filter("up_to", lambda p: p <= u))),
        )
    )
    copies = drawn.filter("copies > 0").select(
        "row", "id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    )
    placed = copies.select(
        "row", "copy", F.md5(F.concat_ws(":", F.lit(f"{seed}"), F.lit("place"), F.col("id"), F.col("copy").cast("string")).cast("binary")).alias("place")
    )
    return placed.repartition("place").sortWithinPartitions("place")
