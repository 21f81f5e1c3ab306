"""The test tables in the shapes the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.functions.nulls import all_present


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw activity events, with about 3 % nulls in each key column."""
    event_id = F.col("event_id")
    kind = F.col("event_type")
    login = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    name = F.concat(F.lit("r"), F.get_json_object("props", "$.k"))
    seconds = F.substring(F.col("ts").cast("string"), 1, 19)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", "ForkEvent")
        .when(kind == "view", "CommitCommentEvent")
        .otherwise(kind)
        .alias("type"),
        F.when(
            event_id % 37 != 0, F.struct(F.when(event_id % 33 != 0, login).alias("login"))
        ).alias("actor"),
        F.when(event_id % 35 != 0, F.struct(name.alias("name"))).alias("repo"),
        F.when(event_id % 31 != 0, F.concat(seconds, F.lit(" UTC"))).alias("created_at"),
    )


def star_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as activity: customers are the users, parts the repositories."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("usr"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    activity = lines.join(orders, "l_orderkey").select(
        F.col("l_orderkey").alias("event_id"), "usr", F.col("l_partkey").alias("repo"), "day"
    )
    return activity.where(all_present("usr", "day"))


def star_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One activity per order, for drawing follow edges between customers."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("usr")
    )


def star_topics(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Parts as repositories with one of their columns as the topic."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("repo"), F.col(topic).alias("topic")
    )
