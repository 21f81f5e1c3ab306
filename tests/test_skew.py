"""One key holds a third of all rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from topicloom.operators.lists import bounded_lists, unnest
from topicloom.operators.skew import hot_keys, skew_join

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))
    )
    null_key = F.when(F.col("id") % 100 == 7, F.lit(None)).otherwise(key)
    return spark.range(ROWS).select(F.col("id").alias("v"), null_key.alias("key"))


def test_hot_keys(skewed):
    rows = hot_keys(skewed.where("key IS NOT NULL"), ["key"], floor=1_000).collect()
    size = skewed.where("key = 'hot'").count()
    assert [(r.key, r.salts) for r in rows] == [("hot", -(-size // 1_000))]


@pytest.mark.parametrize("fan_out", [False, True])
def test_skew_join_equals_join(skewed, spark, fan_out):
    keys = skewed.select("key").where("key IS NOT NULL").distinct()
    right = keys.select("key", F.explode(F.array(F.lit("x"), F.lit("y"))).alias("w"))
    right = right.where("key <> 'k1'").unionByName(
        spark.createDataFrame([(None, "x"), ("absent", "x")], "key string, w string")
    )
    plain = Counter(tuple(r) for r in skewed.join(right, "key").select("v", "key", "w").collect())
    salted = skew_join(skewed, right, "key", floor=500, fan_out=fan_out).select("v", "key", "w")
    assert Counter(tuple(r) for r in salted.collect()) == plain


def test_hot_key_is_spread_over_tasks(skewed, spark):
    right = skewed.select("key").where("key IS NOT NULL").distinct()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew_join(skewed, right, "key", floor=200)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    counts = [r["count"] for r in sizes]
    assert len(counts) == 8 and max(counts) < 1.5 * sum(counts) / len(counts)


def test_lists_are_bounded_and_whole(skewed):
    counted = skewed.groupBy("key", "v").agg(F.lit(2).cast("bigint").alias("n"))
    lists = bounded_lists(counted, ["key"], "v", "vs", max_items=64).persist()
    rows = lists.collect()
    assert max(len(r.vs) for r in rows) == 64
    assert all(len(r.vs) == len(r.counts) and r.n == sum(r.counts) for r in rows)
    assert all(list(r.vs) == sorted(r.vs) for r in rows)
    assert len({(r.key, r.part) for r in rows}) == len(rows)
    hot = sorted(r.part for r in rows if r.key == "hot")
    assert hot == list(range(len(hot))) and len(hot) > 150
    back = Counter(tuple(r) for r in unnest(lists, "vs", "v").select("key", "v", "n").collect())
    expected = Counter(tuple(r) for r in counted.where("key IS NOT NULL").select("key", "v", "n").collect())
    assert back == expected


def test_lists_do_not_depend_on_row_order(skewed):
    counted = skewed.groupBy("key", "v").agg(F.count(F.lit(1)).alias("n"))
    limits = {"max_items": 64}
    one = bounded_lists(counted, ["key"], "v", "vs", **limits)
    other = bounded_lists(counted.repartition(13, "v"), ["key"], "v", "vs", **limits)

    def rows(df):
        return sorted((r.key, r.part, tuple(r.vs)) for r in df.collect())

    assert rows(one) == rows(other)
