"""Rows joined to their groups, however unequal the groups are."""

from clicktally.llm.blocks import join_groups
from pyspark.sql import functions as F


def joined_both_ways(rows, keys, least=1):
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first")).filter(F.col("rows") >= least)
    plain = rows.join(groups.drop("rows"), keys)
    return sorted(map(tuple, join_groups(rows, groups, keys).select(*plain.columns).collect())), sorted(map(tuple, plain.collect()))


def test_a_group_with_most_rows(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id") % 700).alias("key"), (F.col("id") % 2).alias("band"))
    for keys in (["key"], ["band", "key"]):
        for least in (1, 2, 5):
            found, plain = joined_both_ways(rows, keys, least)
            assert found == plain and len(plain) > 1000


def test_groups_of_one_size_and_none(spark):
    rows = spark.range(400).select("id", (F.col("id") % 200).alias("key"))
    found, plain = joined_both_ways(rows, ["key"])
    assert found == plain and len(plain) == 400
    assert joined_both_ways(rows.limit(0), ["key"]) == ([], [])
    assert joined_both_ways(rows, ["key"], least=3) == ([], [])


def test_rows_of_a_crowded_group_are_not_dealt_by_key(spark, capsys):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")).alias("key"))
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    join_groups(rows, groups, ["key"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("BroadcastHashJoin") >= 2
