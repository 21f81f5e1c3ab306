"""The lookups behind the dashboard.

They read flat relations: ``usr, follow`` for the network, ``usr, day, topic`` for the topics.
``operators.lists.unnest`` gives those from the published list tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.text import in_window, iso_text, picker_day, profile_link
from topicloom.session import saved

# Fixed value: users shown for one topic.
SHOWN = 5


def ego_network(edges: DataFrame, user) -> DataFrame:
    """The different edges ``usr, follow`` from one user."""
    return edges.where(F.col("usr") == F.lit(user)).select("usr", "follow").distinct()


def user_follows(edges: DataFrame, user) -> DataFrame:
    """The different users one user follows; none for an unknown user."""
    return ego_network(edges, user).select("follow")


def window_bounds(requests: DataFrame) -> DataFrame:
    """Date-picker text ``from_date, to_date`` as days and as ISO text."""
    days = requests.select(
        picker_day(F.col("from_date")).alias("from_day"),
        picker_day(F.col("to_date")).alias("to_day"),
    )
    return days.select(
        "from_day",
        "to_day",
        iso_text(F.col("from_day")).alias("from_text"),
        iso_text(F.col("to_day")).alias("to_text"),
    )


def of_network(rows: DataFrame, follows: DataFrame) -> DataFrame:
    """Rows whose ``usr`` is a followed user.

    The list is written first, so Spark knows its size when it plans the join: the usual short
    list is broadcast, and the rows of all users are not shuffled to find those of a few.
    """
    followed = follows.select(F.col("follow").alias("usr")).where(F.col("follow").isNotNull())
    return rows.join(saved(followed, "follows"), "usr", "left_semi")


def network_topics(user_topics: DataFrame, follows: DataFrame, start: date, end: date) -> DataFrame:
    """The different topics of the followed users, strictly within the window."""
    within = user_topics.where(in_window(F.col("day"), start, end))
    return of_network(within, follows).select("topic").distinct()


def topic_users(
    user_topics: DataFrame, topic: str, start: date, end: date, shown: int = SHOWN
) -> DataFrame:
    """Up to five users with a topic within the window: earliest first, then by name."""
    within = user_topics.where((F.col("topic") == topic) & in_window(F.col("day"), start, end))
    return (
        within.groupBy("usr")
        .agg(F.min("day").alias("first_day"))
        .orderBy("first_day", "usr")
        .limit(shown)
    )


def network_topic_users(
    user_topics: DataFrame,
    follows: DataFrame,
    topic: str,
    start: date,
    end: date,
    shown: int = SHOWN,
) -> DataFrame:
    """``topic_users`` among the followed users only."""
    return topic_users(of_network(user_topics, follows), topic, start, end, shown)


def topic_user_links(users: DataFrame) -> DataFrame:
    """Users with the address of their profile."""
    return users.select("usr", profile_link(F.col("usr")).alias("link"))
