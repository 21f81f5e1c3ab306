"""Repositories, topics, and what follows for users by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.functions.nulls import all_present
from topicloom.functions.text import hash32
from topicloom.functions.vocabulary import TOPICS
from topicloom.operators.lists import TASK_ROWS, bounded_lists
from topicloom.operators.skew import HOT_FLOOR, each_row, skew_join
from topicloom.session import saved

# Rows of a relation that each task gets whole, some megabytes.
SENT_ROWS = 100_000


def drawn_topic(seed: Column) -> Column:
    """A topic drawn from the vocabulary; the same seed draws the same topic."""
    position = (hash32(seed) % len(TOPICS) + 1).cast("int")
    return F.element_at(F.lit(TOPICS), position)


def repo_topic(activity: DataFrame) -> DataFrame:
    """Simulated relation ``repo, topic`` with one topic per repository."""
    repos = activity.where(F.col("repo").isNotNull()).select("repo").distinct()
    return repos.select("repo", drawn_topic(F.col("repo")).alias("topic"))


def repo_topic_coded(events: DataFrame) -> DataFrame:
    """Simulated relation with one row, and one draw, per event."""
    return events.where(F.col("repo").isNotNull()).select(
        "repo", drawn_topic(F.col("event_id")).alias("topic")
    )


def one_topic_per_repo(repo_topics: DataFrame) -> DataFrame:
    """A single topic per repository: the first by name."""
    return repo_topics.groupBy("repo").agg(F.min("topic").alias("topic"))


def user_topic_bag(activity: DataFrame, repo_topics: DataFrame) -> DataFrame:
    """``usr, day, topic`` for each activity and topic of its repository."""
    return skew_join(activity, repo_topics, "repo").select("usr", "day", "topic")


def user_repo_counts(activity: DataFrame) -> DataFrame:
    """``usr, day, repo, n``: activities counted, where user, day and repository are present."""
    return (
        activity.where(all_present("usr", "day", "repo"))
        .groupBy("usr", "day", "repo")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def user_topic_counts(
    activity: DataFrame, repo_topics: DataFrame, count_first: bool = False
) -> DataFrame:
    """``usr, day, topic, n``: how often each row occurs in the bag of ``user_topic_bag``.

    The topic rows are counted before the join, so a repository with many activities and many
    topic rows never joins every row with every other. ``count_first`` counts the activity as
    well. That is one shuffle more, and pays where a repository has tens of topics, or where the
    activity is no stored table: it is then computed once instead of a second time for its hot
    repositories.
    """
    topics = repo_topics.groupBy("repo", "topic").agg(F.count(F.lit(1)).alias("rows"))
    if count_first:
        counts = user_repo_counts(activity)
        joined = skew_join(counts, topics, "repo", weight=each_row(F.col("n")), fan_out=True)
        n = F.sum(F.col("n") * F.col("rows"))
    else:
        joined = skew_join(activity, topics, "repo")
        n = F.sum("rows")
    return joined.groupBy("usr", "day", "topic").agg(n.alias("n"))


def user_topic_counts_fanned(activity: DataFrame, repo_topics: DataFrame) -> DataFrame:
    """``user_topic_counts`` where repositories have many topics, so that rows become many times as many.

    Both sides are counted and written, so the number of rows that they make is known before they
    meet, and each task makes about ``TASK_ROWS`` of them. Of a relation of at most ``SENT_ROWS`` rows
    each task gets all: the activity is then dealt by user and day, and what comes of it is added up where it
    is made, without being sent. No user and day makes more than those rows. A larger relation is met in
    ``skew_join``.
    """
    topics = saved(repo_topics.groupBy("repo", "topic").agg(F.count(F.lit(1)).alias("rows")), "topic_rows")
    counts = saved(user_repo_counts(activity), "activity_counts")
    per_repo = topics.groupBy("repo").agg(F.count(F.lit(1)).alias("topics"))
    uses = counts.groupBy("repo").agg(F.count(F.lit(1)).alias("uses"))
    made = uses.join(per_repo, "repo").agg(F.sum(F.col("uses") * F.col("topics")), F.sum("uses")).first()
    rows, met = made[0] or 0, made[1] or 0
    tasks = max(1, -(-rows // TASK_ROWS))
    if topics.count() <= SENT_ROWS:
        joined = counts.repartition(tasks, "usr", "day").join(F.broadcast(topics), "repo")
    else:
        floor = max(1, HOT_FLOOR * met // max(1, rows))
        joined = skew_join(counts, topics, "repo", floor=floor, fan_out=tasks)
    return joined.groupBy("usr", "day", "topic").agg(F.sum(F.col("n") * F.col("rows")).alias("n"))


def user_topic_day(counts: DataFrame, **limits) -> DataFrame:
    """(user, day) to the list of topics."""
    return bounded_lists(counts, ["usr", "day"], "topic", "topics", **limits)


def topic_user_day(counts: DataFrame, **limits) -> DataFrame:
    """(topic, day) to the list of users: the inverse relation, from the same counts."""
    return bounded_lists(counts, ["topic", "day"], "usr", "users", **limits)


def user_repo_day(activity: DataFrame, **limits) -> DataFrame:
    """(user, day) to the list of repositories."""
    return bounded_lists(user_repo_counts(activity), ["usr", "day"], "repo", "repos", **limits)
