"""Cleaning of raw events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.nulls import all_present
from topicloom.functions.text import event_day

# The event types that count as activity.
ACTIVITY_TYPES = ("ForkEvent", "CommitCommentEvent")


def flat_events(raw: DataFrame) -> DataFrame:
    """Nested fields as columns; a missing actor or repository gives null."""
    return raw.select(
        "event_id",
        "type",
        F.col("actor.login").alias("login"),
        F.col("repo.name").alias("repo"),
        "created_at",
    )


def filter_event_types(raw: DataFrame) -> DataFrame:
    """Events of the two activity types."""
    return raw.where(F.col("type").isin(*ACTIVITY_TYPES))


def clean_events(raw: DataFrame) -> DataFrame:
    """Activity events with user, repository and time all present."""
    events = flat_events(filter_event_types(raw)).drop("type")
    return events.where(all_present("login", "repo", "created_at"))


def clean_events_sql(raw: DataFrame) -> DataFrame:
    """``clean_events`` as SQL text over a registered table."""
    return raw.sparkSession.sql(
        """
        SELECT event_id, actor.login AS login, repo.name AS repo, created_at
        FROM {raw}
        WHERE type IN (:fork, :comment)
          AND actor.login IS NOT NULL AND repo.name IS NOT NULL AND created_at IS NOT NULL
        """,
        args={"fork": ACTIVITY_TYPES[0], "comment": ACTIVITY_TYPES[1]},
        raw=raw,
    )


def clean_events_coded(raw: DataFrame) -> DataFrame:
    """The looser filter: the null checks guard commit comments only, and a null time drops all.

    Forks without actor or repository stay, with nulls.
    """
    fork, comment = ACTIVITY_TYPES
    whole = all_present("actor", "repo")
    kept = raw.where((F.col("type") == fork) | ((F.col("type") == comment) & whole))
    return flat_events(kept.where(all_present("created_at"))).drop("type")


def user_repo(events: DataFrame) -> DataFrame:
    """Activity ``event_id, usr, repo, day`` of cleaned events with a user and a valid day."""
    day = event_day(F.col("created_at")).alias("day")
    activity = events.select("event_id", F.col("login").alias("usr"), "repo", day)
    return activity.where(all_present("usr", "day"))


def null_profile(raw: DataFrame) -> DataFrame:
    """Nulls per key column among activity events; ``day`` also counts times that are no date."""
    events = flat_events(filter_event_types(raw)).withColumn("day", event_day(F.col("created_at")))
    names = ["login", "repo", "created_at", "day"]
    totals = events.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names]
    )
    pairs = ", ".join(f"'{name}', `{name}`" for name in names)
    counts = totals.select("rows", F.expr(f"stack({len(names)}, {pairs})").alias("column", "nulls"))
    share = F.col("nulls").cast("double") / F.col("rows")
    return counts.select("column", "nulls", "rows", share.alias("share"))
