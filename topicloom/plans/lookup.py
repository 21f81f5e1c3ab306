"""The dashboard's questions, asked of the tables that the daily job publishes.

Each reads only the days of its window and the buckets of the keys it asks for.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.functions.text import picker_day
from topicloom.operators import serve
from topicloom.operators.lists import unnest
from topicloom.sources.tables import buckets_of, of_key, of_keys, read_days, read_latest


def request_day(spark: SparkSession, text: str) -> date:
    """The day in a request's date-picker text, such as "Mon Jan 01 2018"."""
    day = spark.range(1).select(picker_day(F.lit(text))).first()[0]
    if day is None:
        raise ValueError(f"no date such as 'Mon Jan 01 2018': {text!r}")
    return day


def _window(spark: SparkSession, from_date: str, to_date: str) -> tuple[date, date]:
    return request_day(spark, from_date), request_day(spark, to_date)


def follows_of(spark: SparkSession, out: str, user) -> DataFrame:
    """The different users that one user follows."""
    lists = read_latest(spark, f"{out}/useruser", value=user)
    return serve.user_follows(unnest(lists, "follows", "follow"), user)


def network_rows(spark: SparkSession, out: str, user, start: date, end: date) -> DataFrame:
    """``usr, day, topic`` of the users that a user follows, strictly between two days."""
    path = f"{out}/usertopic"
    lists = read_days(spark, path, start, end)
    mine = of_keys(lists, follows_of(spark, out, user), "usr", buckets_of(spark, path))
    return unnest(mine, "topics", "topic").select("usr", "day", "topic")


def topic_rows(spark: SparkSession, out: str, topic: str, start: date, end: date) -> DataFrame:
    """``usr, day, topic`` of one topic, strictly between two days."""
    path = f"{out}/topicuser"
    lists = of_key(read_days(spark, path, start, end), "topic", topic, buckets_of(spark, path))
    return unnest(lists, "users", "usr").select("usr", "day", "topic")


def topics_of_network(
    spark: SparkSession, out: str, user: str, from_date: str, to_date: str
) -> DataFrame:
    """Topics of the users that a user follows, between two days given as date-picker text."""
    rows = network_rows(spark, out, user, *_window(spark, from_date, to_date))
    return rows.select("topic").distinct()


def repos_of_user(
    spark: SparkSession, out: str, user: str, from_date: str, to_date: str
) -> DataFrame:
    """Repositories that a user works on between two days given as date-picker text."""
    path = f"{out}/userrepo"
    lists = read_days(spark, path, *_window(spark, from_date, to_date))
    mine = of_key(lists, "usr", user, buckets_of(spark, path))
    return unnest(mine, "repos", "repo").select("repo").distinct()


def users_of_topic(
    spark: SparkSession, out: str, topic: str, from_date: str, to_date: str, user: str | None = None
) -> DataFrame:
    """Up to five users with a topic, with profile links; of one user's network where given."""
    start, end = _window(spark, from_date, to_date)
    rows = topic_rows(spark, out, topic, start, end)
    if user is None:
        found = serve.topic_users(rows, topic, start, end)
    else:
        found = serve.network_topic_users(rows, follows_of(spark, out, user), topic, start, end)
    return serve.topic_user_links(found)
