"""The first n rows by a key, without passing n rows through one task."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

# Bits resolved per pass: the driver sees at most 2**12 + 1 counts for each size at a time.
_BITS_PER_PASS = 12


def first_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """The n rows with the smallest ``key``, a unique integer column without NULLs.

    ``limit(n)`` takes any n rows and leaves them in one partition.  This finds
    the n-th smallest key and filters on it, so the result is always the same
    rows, keeps the partitions of ``df`` and lets Parquet skip row groups past
    the cutoff.  A table with n rows or fewer comes back whole.
    """
    if n <= 0:
        return df.limit(0)
    cutoff = nth_smallest(df, [n], key)[n]
    return df if cutoff is None else df.filter(F.col(key) <= F.lit(cutoff))


def nth_smallest(df: DataFrame, sizes: Sequence[int], key: str) -> dict[int, int | None]:
    """For each n the n-th smallest key, None if there are at most n rows.

    Counts keys in equal ranges, then looks only inside the ranges that hold
    the keys sought, all of them in one pass; each pass settles twelve more
    bits.  The key below the smallest stands for n = 0.
    """
    if not isinstance(df.schema[key].dataType, (ByteType, ShortType, IntegerType, LongType)):
        raise ValueError(f"first_n needs an integer key, {key} is not one")

    keys = df.select(F.col(key).cast("bigint").alias("key"))
    low, high, keyed, rows = keys.agg(
        F.min("key"), F.max("key"), F.count("key"), F.count(F.lit(1))
    ).first()
    if keyed < rows:
        raise ValueError(f"first_n needs a key without NULLs, {key} has {rows - keyed}")

    found: dict[int, int | None] = {n: None if n >= rows else max(low - 1, -(2**63)) for n in sizes if n >= rows or n <= 0}
    # Of each n still open: the range its key lies in and the number of keys before that.
    open_ranges = {n: (low, high, 0) for n in sizes if n not in found}
    while open_ranges:
        spans = sorted({span[:2] for span in open_ranges.values()})
        # Shifting right floors for negative keys too and cannot overflow.
        place, shifted, wanted = F.lit(None).cast("int"), F.lit(None).cast("bigint"), F.lit(False)
        for i, (first, last) in enumerate(spans):
            inside = F.col("key").between(first, last)
            wanted = wanted | inside
            place = F.when(inside, i).otherwise(place)
            shifted = F.when(inside, F.shiftright("key", max(0, (last - first).bit_length() - _BITS_PER_PASS))).otherwise(shifted)
        counts = (
            keys.filter(wanted)
            .select("key", place.alias("span"), shifted.alias("range"))
            .groupBy("span", "range")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()
        )
        counts.sort(key=lambda hit: (hit["span"], hit["range"]))
        for n, (first, last, before) in list(open_ranges.items()):
            for hit in (hit for hit in counts if spans[hit["span"]] == (first, last)):
                if before + hit["rows"] >= n:
                    break
                before += hit["rows"]
            if before + hit["rows"] == n:
                found[n] = hit["high"]
                del open_ranges[n]
            elif hit["low"] == hit["high"]:
                raise ValueError(f"first_n needs a unique key, {key} = {hit['low']} repeats")
            else:
                open_ranges[n] = (hit["low"], hit["high"], before)
    return found
