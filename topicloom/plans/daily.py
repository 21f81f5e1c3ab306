r"""The daily job: from event files to the published tables.

    spark-submit --py-files topicloom.zip topicloom/plans/daily.py \
        --events 's3a://<bucket>/2018/2018-01-*.json.gz' --first 2018-01-01 --last 2018-01-31 \
        --out s3a://<bucket>/tables --run 201801
"""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from topicloom.functions.nulls import all_present
from topicloom.operators import follows, topics
from topicloom.session import build_session, scratch_scope
from topicloom.sources.events import judged_lines, staged_lines, stored_events
from topicloom.sources.tables import BUCKETS, publish_days, publish_latest, read_days


def run_days(
    spark: SparkSession,
    globs: list[str],
    out: str,
    first: date,
    last: date,
    run: int,
    repo_topics: DataFrame | None = None,
    id_field: str = "event_id",
    follows_of: DataFrame | None = None,
    most_broken: float = 0.01,
    buckets: int = BUCKETS,
) -> dict[str, int]:
    """Read, clean and land the events of some days, then publish the tables.

    The files hold those days whole; events of other days in them are rejects. The event files are parsed
    once, in one pass that counts and parts the lines; every later step reads what that pass wrote, or the
    landed table, of which it needs a few columns and only the folders of these days. ``repo_topics`` is the
    relation ``repo, topic`` and ``follows_of`` the relation ``usr, follow``, in which a repeated row counts
    once; without one it is simulated. Rejected lines are published with the run (``rejects``).

    Returns the lines per outcome (see ``judged_lines``). Broken ones beyond the share ``most_broken`` are an
    error, before anything is published. Scratch folders are removed at the end.
    """
    with scratch_scope(spark):
        stored = stored_events(spark, *globs, id_field=id_field)
        lines, account = staged_lines(judged_lines(stored, id_field, first, last))
        total = sum(account.values())
        if account["broken"] > most_broken * total:
            raise ValueError(f"{account['broken']} of {total} lines are no JSON")

        def publish(rows: DataFrame, table: str, key: str) -> DataFrame:
            """The table's rows of these days, as a reader finds them."""
            path = f"{out}/{table}"
            publish_days(rows, path, key, covered=(first, last), buckets=buckets)
            within = (first - timedelta(days=1), last + timedelta(days=1))
            return read_days(spark, path, *within).drop("bucket")

        clean = lines.where("outcome = 'clean'").select("event_id", "usr", "repo", "day")
        activity = publish(clean, "activity", "usr")
        rejects = lines.where("outcome != 'clean'").select("file", "outcome", "event_id", "created_at", "line")
        publish_latest(rejects, f"{out}/rejects", "file", run)
        # A given repository may have many topics: rows are then counted before they meet.
        given = repo_topics is not None
        repo_topics = repo_topics if given else topics.repo_topic(activity)
        counted = topics.user_topic_counts_fanned if given else topics.user_topic_counts
        counts = counted(activity, repo_topics)
        counts = publish(counts, "counts", "usr")
        publish(topics.user_topic_day(counts), "usertopic", "usr")
        publish(topics.topic_user_day(counts), "topicuser", "topic")
        publish(topics.user_repo_day(activity), "userrepo", "usr")
        if follows_of is not None:
            both = follows_of.select("usr", "follow").where(all_present("usr", "follow"))
            edges = both.distinct()
        else:
            edges = follows.follow_edges(activity, follows.user_index(activity))
        publish_latest(follows.user_user(edges), f"{out}/useruser", "usr", run)
    return account


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--events", nargs="+", required=True, help="globs of event files")
    parser.add_argument("--out", required=True, help="folder of the published tables")
    parser.add_argument("--first", type=date.fromisoformat, required=True, help="first day")
    parser.add_argument("--last", type=date.fromisoformat, required=True, help="last day")
    parser.add_argument("--run", type=int, required=True, help="number of the run; newer is higher")
    parser.add_argument("--repo-topics", help="Parquet table repo, topic")
    parser.add_argument("--follows", help="Parquet table usr, follow")
    parser.add_argument("--id-field", default="id", help="name of the unique id in the files")
    args = parser.parse_args()
    spark = build_session("topicloom daily")
    given = spark.read.parquet(args.repo_topics) if args.repo_topics else None
    edges = spark.read.parquet(args.follows) if args.follows else None
    account = run_days(
        spark, args.events, args.out, args.first, args.last, args.run, given, args.id_field, edges
    )
    print(account)


if __name__ == "__main__":
    main()
