"""Late, corrected and withdrawn events: the published tables brought up to date without a full run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.operators import topics
from topicloom.operators.deltas import (
    delta_counts,
    delta_repo_counts,
    signed_activity,
    touched_counts,
)
from topicloom.operators.lists import bounded_lists
from topicloom.session import saved, scratch_scope
from topicloom.sources.tables import publish_days, read_days


def apply_changes(
    spark: SparkSession, out: str, changes: DataFrame, repo_topics: DataFrame
) -> dict[str, int]:
    """Bring the tables of ``out`` up to date with changed events; returns how many keys each has touched.

    ``changes`` are ``event_id, usr, repo, day, withdrawn`` (see ``signed_activity``), ``repo_topics`` the relation
    by which the tables were built. The activity is read for the events named; of counts and lists only the
    days and keys touched are read and rebuilt. Applying the same changes again changes nothing. Each
    table is switched over by itself: if a run is killed between two of them, run it again with the days' full
    files, as the activity may be ahead of the lists.
    """
    done = {}
    with scratch_scope(spark):
        activity = read_days(spark, f"{out}/activity")
        signed = saved(signed_activity(activity, changes), "signed")
        delta = saved(delta_counts(signed, repo_topics), "delta")
        repos = saved(delta_repo_counts(signed), "repos")
        days = [r.day for r in signed.select("day").distinct().collect()]  # a row per day
        counts = read_days(spark, f"{out}/counts").where(F.col("day").isin(days))

        def publish(rows: DataFrame, table: str, key: str, touched: DataFrame, by=None) -> None:
            by = by or [key]
            touched = saved(touched.select(*by, "day").distinct(), "touched")
            publish_days(rows, f"{out}/{table}", key, whole_days=False, touched=touched, by=by)
            done[table] = touched.count()

        def lists(of: DataFrame, change: DataFrame, table: str, key: str, item: str, name: str) -> None:
            new = touched_counts(of, change, [key, "day"])
            publish(bounded_lists(new, [key, "day"], item, name), table, key, change)

        if not days:
            return done
        # The lists first: they are made from the counts and the activity as they were.
        lists(counts, delta, "usertopic", "usr", "topic", "topics")
        lists(counts, delta, "topicuser", "topic", "usr", "users")
        users = signed.select("usr", "day").distinct()
        known = topics.user_repo_counts(
            activity.where(F.col("day").isin(days)).join(users, ["usr", "day"], "left_semi")
        )
        lists(known, repos, "userrepo", "usr", "repo", "repos")
        publish(touched_counts(counts, delta, ["usr", "day"]), "counts", "usr", delta)
        new = signed.where("sign > 0").drop("sign")
        publish(new, "activity", "usr", signed, by=["event_id"])
    return done
