"""Counts kept up to date by signed changes, so that a late or corrected event rebuilds a few lists only.

A change brings an event as it should be, or withdraws it. What the stored activity has of that event counts
-1, what the change brings +1. Joined with the topics and summed up, that is what the stored counts are
off by; keys whose sums come to nothing are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.nulls import all_present
from topicloom.operators.skew import skew_join


def signed_activity(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """``event_id, usr, repo, day, sign``: rows taken from the stored activity and rows put into it.

    ``changes`` are ``event_id, usr, repo, day, withdrawn``, one row per event; rows that repeat count once.
    A withdrawn event that is not stored changes nothing, nor does one that is stored as it should be.
    """
    columns = ("event_id", "usr", "repo", "day")
    changes = changes.where(F.col("event_id").isNotNull()).distinct()
    ids = changes.select("event_id").distinct()
    old = stored.select(*columns).join(ids, "event_id", "left_semi").withColumn("sign", F.lit(-1))
    new = changes.where(~F.col("withdrawn") & all_present("usr", "day")).select(*columns)
    both = old.unionByName(new.withColumn("sign", F.lit(1)))
    return both.groupBy(*columns).agg(F.sum("sign").alias("sign")).where("sign != 0")


def delta_counts(signed: DataFrame, repo_topics: DataFrame, **skew) -> DataFrame:
    """What the counts are off by: ``usr, day, topic, n`` with n above or below zero."""
    topics = repo_topics.groupBy("repo", "topic").agg(F.count(F.lit(1)).alias("rows"))
    joined = skew_join(signed, topics, "repo", **skew)
    n = F.sum(F.col("sign") * F.col("rows")).alias("n")
    return joined.groupBy("usr", "day", "topic").agg(n).where("n != 0")


def delta_repo_counts(signed: DataFrame) -> DataFrame:
    """The same for the repositories of users: ``usr, day, repo, n``."""
    sums = signed.where(F.col("repo").isNotNull()).groupBy("usr", "day", "repo")
    return sums.agg(F.sum("sign").alias("n")).where("n != 0")


def touched_counts(stored: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """The new counts of the keys that a delta touches, in the columns of ``delta``.

    Rows of other keys are not read beyond the semi-join. A key of which nothing is left has no rows.
    """
    items = [c for c in delta.columns if c != "n"]
    touched = delta.select(*keys).distinct()
    before = stored.select(*delta.columns).join(touched, keys, "left_semi")
    sums = before.unionByName(delta).groupBy(*items).agg(F.sum("n").alias("n"))
    return sums.where("n > 0")
