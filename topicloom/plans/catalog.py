"""The registered queries, each over the whole test tables.

Keys without a suffix read ``events`` as raw activity events; keys ending in ``_star`` read order
lines as activity. List columns are returned as joined text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.functions.text import event_day, in_window, picker_text
from topicloom.functions.vocabulary import TOPICS, topic_vocabulary
from topicloom.operators import clean, follows, network, serve, topics, windows
from topicloom.operators.lists import unnest
from topicloom.plans import lookup
from topicloom.plans.changes import apply_changes
from topicloom.plans.daily import run_days
from topicloom.session import saved, scratch_path
from topicloom.sources.events import judged_lines, read_events, staged_lines, stored_events
from topicloom.sources.tables import (
    compact,
    publish_days,
    publish_latest,
    read_days,
    read_latest,
    read_runs,
    remove_merged,
)
from topicloom.sources.testdata import raw_events, star_activity, star_orders, star_topics, table
from topicloom.streaming import load_new_files

Query = Callable[[SparkSession, str], DataFrame]

USER = "u8"
TOPIC = TOPICS[118]
START, END = date(2024, 1, 2), date(2024, 1, 6)
TOPIC_END = date(2024, 1, 20)
MORE_THAN = 80
HOPS = 3
REJECT_DAYS = (date(2024, 1, 1), date(2024, 1, 20))

STAR_USER = 8
STAR_TOPIC = "ECONOMY"
STAR_START, STAR_END = date(1997, 1, 1), date(1997, 7, 1)

# Buckets of published tables; the test tables have a few hundred rows a day.
FEW = 4

# Small limits, so that the test tables have lists of several parts and salted keys.
SMALL = {"max_items": 4}


def _text(lists: DataFrame, name: str) -> DataFrame:
    joined = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in (name, "counts")}
    return lists.withColumns(joined)


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.user_repo(clean.clean_events(raw_events(spark, sf_dir)))


def _coded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_events_coded(raw_events(spark, sf_dir))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = _activity(spark, sf_dir)
    return follows.follow_edges(activity, follows.user_index(activity))


def _star_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_orders(spark, sf_dir)
    return follows.follow_edges(orders, follows.user_index(orders))


def _counts(
    spark: SparkSession, sf_dir: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    activity = _activity(spark, sf_dir)
    # The relation between repositories and topics comes from all activity, the rest from the
    # days asked for.
    repo_topics = topics.repo_topic(activity)
    if start and end:
        activity = activity.where(in_window(F.col("day"), start, end))
    return topics.user_topic_counts(activity, repo_topics, count_first=True)


def _star_counts(
    spark: SparkSession, sf_dir: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    activity = star_activity(spark, sf_dir)
    if start and end:
        activity = activity.where(in_window(F.col("day"), start, end))
    types = star_topics(spark, sf_dir, "p_type")
    return topics.user_topic_counts(activity, types, count_first=True)


def _coded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _coded_events(spark, sf_dir)
    repo_topics = topics.repo_topic_coded(events)
    return topics.user_topic_counts_fanned(clean.user_repo(events), repo_topics)


def _coded_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = clean.user_repo(_coded_events(spark, sf_dir))
    return follows.follow_edges(activity, follows.activity_index(activity))


def _brand_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = star_topics(spark, sf_dir, "p_brand")
    return topics.user_topic_counts(star_activity(spark, sf_dir), brands, count_first=True)


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as gzipped JSON by day, then read as two periods by glob."""
    raw = raw_events(spark, sf_dir)
    path = scratch_path(spark, "json")
    period = F.coalesce(F.substring("created_at", 1, 7), F.lit("unknown"))
    by_period = raw.withColumn("period", period).hint("rebalance", "period")
    by_period.write.partitionBy("period").json(path, compression="gzip")
    events = read_events(spark, f"{path}/period=[0-9]*/*.json.gz", f"{path}/period=[^0-9]*/*.json.gz")
    return clean.flat_events(events)


def topic_vocabulary_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each topic of the vocabulary with the number of repositories that have it."""
    repo_topics = topics.repo_topic(_activity(spark, sf_dir))
    used = repo_topics.groupBy("topic").agg(F.count("repo").alias("n"))
    # The vocabulary has 177 rows and ``used`` at most as many.
    return (
        topic_vocabulary(spark)
        .join(used, "topic", "left")
        .select("topic_id", "topic", F.coalesce(F.col("n"), F.lit(0)).alias("repos"))
    )


def days_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = event_day(F.col("created_at")).alias("day")
    return raw_events(spark, sf_dir).select("event_id", day)


def window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's user asks for the week after the event, as date-picker text."""
    day = event_day(F.col("created_at"))
    asked = raw_events(spark, sf_dir).select(
        picker_text(day).alias("from_date"), picker_text(F.date_add(day, 7)).alias("to_date")
    )
    return serve.window_bounds(asked)


def network_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the followed users' activity within the window is joined with topics."""
    followed = serve.user_follows(_edges(spark, sf_dir), USER)
    activity = _activity(spark, sf_dir)
    asked = serve.of_network(activity.where(in_window(F.col("day"), START, END)), followed)
    counts = topics.user_topic_counts(asked, topics.repo_topic(activity), count_first=True)
    return counts.select("topic").distinct()


def network_topics_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _coded_events(spark, sf_dir)
    activity = clean.user_repo(events)
    edges = _coded_edges(spark, sf_dir)
    within = activity.where(in_window(F.col("day"), START, END))
    counts = topics.user_topic_counts_fanned(within, topics.repo_topic_coded(events))
    return serve.network_topics(counts, serve.user_follows(edges, USER), START, END)


def network_topics_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    followed = serve.user_follows(_star_edges(spark, sf_dir), STAR_USER)
    counts = _star_counts(spark, sf_dir, STAR_START, STAR_END)
    return serve.network_topics(counts, followed, STAR_START, STAR_END)


def _published_follows(spark: SparkSession, sf_dir: str, out: str) -> None:
    publish_latest(follows.user_user(_edges(spark, sf_dir)), f"{out}/useruser", "usr", run=1)


def network_topics_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup over the published list tables."""
    out = scratch_path(spark, "published")
    _published_follows(spark, sf_dir, out)
    publish_days(topics.user_topic_day(_counts(spark, sf_dir)), f"{out}/usertopic", "usr", buckets=FEW)
    return lookup.network_rows(spark, out, USER, START, END).select("topic").distinct()


def topic_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.topic_users(_counts(spark, sf_dir, START, TOPIC_END), TOPIC, START, TOPIC_END)


def topic_users_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _star_counts(spark, sf_dir, STAR_START, STAR_END)
    return serve.topic_users(counts, STAR_TOPIC, STAR_START, STAR_END)


def topic_users_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup over the published list table."""
    out = scratch_path(spark, "published")
    publish_days(topics.topic_user_day(_counts(spark, sf_dir)), f"{out}/topicuser", "topic", buckets=FEW)
    rows = lookup.topic_rows(spark, out, TOPIC, START, TOPIC_END)
    return serve.topic_users(rows, TOPIC, START, TOPIC_END)


def network_topic_users_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup among a user's network over the published list tables."""
    out = scratch_path(spark, "published")
    _published_follows(spark, sf_dir, out)
    publish_days(topics.topic_user_day(_counts(spark, sf_dir)), f"{out}/topicuser", "topic", buckets=FEW)
    rows = lookup.topic_rows(spark, out, TOPIC, START, TOPIC_END)
    followed = lookup.follows_of(spark, out, USER)
    return serve.network_topic_users(rows, followed, TOPIC, START, TOPIC_END)


def user_repos_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup of one user's repositories over the published list table."""
    out = scratch_path(spark, "published")
    publish_days(topics.user_repo_day(_activity(spark, sf_dir)), f"{out}/userrepo", "usr", buckets=FEW)
    window = (START, TOPIC_END)
    texts = spark.range(1).select(*(picker_text(F.lit(day)) for day in window)).first()
    return lookup.repos_of_user(spark, out, USER, *texts)


def network_topic_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    followed = serve.user_follows(_edges(spark, sf_dir), USER)
    counts = _counts(spark, sf_dir, START, TOPIC_END)
    return serve.network_topic_users(counts, followed, TOPIC, START, TOPIC_END)


def topic_user_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.topic_user_links(topic_users(spark, sf_dir))


def publish_user_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same events, read back."""
    path = scratch_path(spark, "useruser")
    lists = saved(follows.user_user(_edges(spark, sf_dir)), "lists")
    for run in (1, 2):
        publish_latest(lists, path, "usr", run)
    return _text(read_latest(spark, path), "follows")


def publish_user_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published twice, read back."""
    path = scratch_path(spark, "usertopic")
    lists = saved(topics.user_topic_day(_counts(spark, sf_dir)), "lists")
    for _ in range(2):
        publish_days(lists, path, "usr", buckets=FEW)
    return _text(read_days(spark, path).drop("bucket"), "topics")


def publish_topic_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published twice, the second time key by key, read back."""
    path = scratch_path(spark, "topicuser")
    lists = saved(topics.topic_user_day(_counts(spark, sf_dir)), "lists")
    publish_days(lists, path, "topic", buckets=FEW)
    publish_days(lists, path, "topic", whole_days=False, buckets=FEW)
    return _text(read_days(spark, path).drop("bucket"), "users")


def publish_user_user_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three thirds of the users as runs 1, 5 and 3, read back: a late run is not lost."""
    path = scratch_path(spark, "useruser")
    lists = saved(follows.user_user(_edges(spark, sf_dir)), "lists")
    third = F.pmod(F.length("usr") + F.ascii(F.reverse("usr")), F.lit(3))
    for k, run in enumerate((1, 5, 3)):
        publish_latest(lists.where(third == k), path, "usr", run)
    return _text(read_latest(spark, path), "follows")


def publish_user_topic_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, then the same days again without those within a window, read back."""
    path = scratch_path(spark, "usertopic")
    lists = saved(topics.user_topic_day(_counts(spark, sf_dir)), "lists")
    publish_days(lists, path, "usr", buckets=FEW)
    kept = lists.where(~in_window(F.col("day"), START, END))
    publish_days(kept, path, "usr", covered=(date(2024, 1, 1), date(2024, 1, 31)), buckets=FEW)
    return _text(read_days(spark, path).drop("bucket"), "topics")


def publish_user_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd and even users published in turn, key by key, read back."""
    path = scratch_path(spark, "userrepo")
    lists = saved(topics.user_repo_day(_activity(spark, sf_dir)), "lists")
    for rest in (0, 1, 0):
        half = lists.where(F.pmod(F.ascii(F.reverse("usr")), F.lit(2)) == rest)
        publish_days(half, path, "usr", whole_days=False, buckets=FEW)
    return _text(read_days(spark, path).drop("bucket"), "repos")


def publish_user_user_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three thirds of the users as runs 1, 5 and 3, two of them merged before the third comes."""
    path = scratch_path(spark, "useruser")
    lists = saved(follows.user_user(_edges(spark, sf_dir)), "lists")
    third = F.pmod(F.length("usr") + F.ascii(F.reverse("usr")), F.lit(3))
    for k, run in enumerate((1, 5)):
        publish_latest(lists.where(third == k), path, "usr", run)
    compact(spark, path)
    remove_merged(spark, path)
    publish_latest(lists.where(third == 2), path, "usr", 3)
    return _text(read_latest(spark, path), "follows")


def event_files(spark: SparkSession, sf_dir: str) -> str:
    """``events`` as gzipped JSON, in which the lines of every 41st event are cut off; the folder."""
    raw = raw_events(spark, sf_dir)
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"))
    whole = F.to_json(F.struct(*raw.columns))
    lines = raw.select(F.when(F.col("event_id") % 41 == 0, cut).otherwise(whole).alias("value"))
    path = scratch_path(spark, "json")
    lines.write.text(path, compression="gzip")
    return path


def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of event files that are no clean activity within a window, and why."""
    stored = stored_events(spark, event_files(spark, sf_dir))
    lines, _ = staged_lines(judged_lines(stored, "event_id", *REJECT_DAYS))
    return lines.where("outcome != 'clean'").select("outcome", "event_id", "line")


def _list_rows(lists: DataFrame, table: str, key: str, name: str) -> DataFrame:
    rows = unnest(lists, name, "item")
    return rows.select(F.lit(table).alias("name"), F.col(key).alias("key"), "day", "item", "n")


def day_lists(spark: SparkSession, out: str) -> DataFrame:
    """The published day lists as rows."""
    tables = (("usertopic", "usr", "topics"), ("topicuser", "topic", "users"), ("userrepo", "usr", "repos"))
    rows = [_list_rows(read_days(spark, f"{out}/{table}"), table, key, name) for table, key, name in tables]
    return reduce(DataFrame.unionByName, rows)


def daily_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that the daily job publishes, from files of all days, read back."""
    out, files = scratch_path(spark, "tables"), scratch_path(spark, "json")
    raw_events(spark, sf_dir).write.json(files, compression="gzip")
    run_days(spark, [files], out, date(2024, 1, 1), date(2024, 1, 31), run=1, buckets=FEW)

    lists = read_latest(spark, f"{out}/useruser").withColumn("day", F.lit(None).cast("date"))
    return day_lists(spark, out).unionByName(_list_rows(lists, "useruser", "usr", "follows"))


def user_requests(activity: DataFrame) -> DataFrame:
    """One request per user, who asks for some days from their own first one on."""
    own = activity.groupBy("usr").agg(F.min("day").alias("start"), F.count("*").alias("n"))
    length = (F.lit(4) + F.col("n") % 23).cast("int")
    return own.select(F.col("usr").alias("request"), "usr", "start", F.date_add("start", length).alias("end"))


def network_topics_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user of the events asks for the topics of the network at once."""
    activity = _activity(spark, sf_dir)
    return windows.network_topics_requests(
        _counts(spark, sf_dir), _edges(spark, sf_dir), user_requests(activity)
    )


def topic_users_any_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first users of every topic in every window between its first and last day."""
    counts = saved(_counts(spark, sf_dir), "counts")
    spans = counts.groupBy("topic").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    starts = F.explode(F.expr("sequence(date_sub(first, 1), last)")).alias("start")
    ends = F.explode(F.expr("sequence(date_add(start, 1), date_add(last, 1))")).alias("end")
    asked = spans.select("topic", "last", starts).select("topic", "start", ends)
    asked = asked.withColumn("request", F.struct("topic", "start", "end"))
    found = windows.topic_users_requests(windows.first_users(counts), asked)
    return found.select("request.*", "usr", "first_day")


def tables_by_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables built with events missing, wrong and too many, then put right by their changes."""
    out = scratch_path(spark, "tables")
    activity = saved(_activity(spark, sf_dir), "activity")
    event = F.col("event_id")
    late, wrong, extra = event % 3 == 0, event % 7 == 1, event % 5 == 2
    other = F.when(wrong, F.lit("r1")).otherwise(F.col("repo")).alias("repo")
    moved = F.when(wrong, F.date_add("day", 1)).otherwise(F.col("day")).alias("day")
    kept = activity.where(~late).select("event_id", "usr", other, moved)
    surplus = activity.where(extra).withColumn("event_id", -event)
    before = saved(kept.unionByName(surplus), "before")
    repo_topics = saved(topics.repo_topic(before.unionByName(activity)), "repo_topics")
    counts = saved(topics.user_topic_counts(before, repo_topics), "counts")
    for rows, name, key in (
        (before, "activity", "usr"),
        (counts, "counts", "usr"),
        (topics.user_topic_day(counts), "usertopic", "usr"),
        (topics.topic_user_day(counts), "topicuser", "topic"),
        (topics.user_repo_day(before), "userrepo", "usr"),
    ):
        publish_days(rows, f"{out}/{name}", key, buckets=2)
    right = activity.where(late | wrong).withColumn("withdrawn", F.lit(False))
    changes = right.unionByName(surplus.withColumn("withdrawn", F.lit(True)))
    apply_changes(spark, out, changes, repo_topics)
    return day_lists(spark, out)


def load_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files, of which the second repeats events of the first, loaded as they come."""
    files, out = scratch_path(spark, "drops"), scratch_path(spark, "tables")
    checkpoint = scratch_path(spark, "checkpoint")
    raw = raw_events(spark, sf_dir)
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 3 != 2):
        raw.where(part).coalesce(2).write.mode("append").json(files, compression="gzip")
        load_new_files(spark, files, out, checkpoint, buckets=2)
    return read_days(spark, f"{out}/activity").drop("bucket")


def given_follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers follow the suppliers they order from: a relation with repeated rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("usr"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("follow")
    )
    return lines.join(orders, "o_orderkey").select("usr", "follow")


def supplier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers work on the parts they ship; topics are the parts' types."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("usr"),
        F.col("l_partkey").alias("repo"),
        F.col("l_shipdate").cast("date").alias("day"),
    )
    within = lines.where(in_window(F.col("day"), STAR_START, STAR_END))
    return topics.user_topic_counts(within, star_topics(spark, sf_dir, "p_type"), count_first=True)


def ego_network_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whom every tenth event's follows lead to from two users, within three steps."""
    edges = _edges(spark, sf_dir).where(F.col("event_id") % 10 == 0)
    starts = edges.where(F.col("usr").isin(USER, "u1")).select("usr")
    return network.ego_network_hops(edges, starts, HOPS)


def popular_users_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact numbers of followers, and whether the merged sketches of three runs come near each."""
    edges = saved(given_follows(spark, sf_dir), "given")
    path = scratch_path(spark, "sketches")
    for run in range(3):
        part = edges.where((F.col("usr") + F.col("follow")) % 3 >= run)  # runs overlap
        publish_latest(follows.follower_sketches(part), path, "follow", run)
    near = follows.estimated_followers(read_runs(spark, path))
    off = F.abs(F.col("estimate") - F.col("n")) / F.col("n")
    exact = follows.popular_users(edges, 0).join(near, "follow", "left")
    return exact.select("follow", "n", (off <= 4 * follows.SKETCH_ERROR).alias("near"))


def network_topics_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    followed = serve.user_follows(given_follows(spark, sf_dir), STAR_USER)
    return serve.network_topics(supplier_counts(spark, sf_dir), followed, STAR_START, STAR_END)


def network_topic_users_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    followed = serve.user_follows(given_follows(spark, sf_dir), STAR_USER)
    counts = supplier_counts(spark, sf_dir)
    return serve.network_topic_users(counts, followed, STAR_TOPIC, STAR_START, STAR_END)


def catalog() -> dict[str, Query]:
    events = {
        "load_events": load_events,
        "topic_vocabulary": topic_vocabulary_use,
        "filter_event_types": lambda spark, sf_dir: clean.filter_event_types(
            raw_events(spark, sf_dir)
        ).select("event_id", "type"),
        "clean_events": lambda spark, sf_dir: clean.clean_events(raw_events(spark, sf_dir)),
        "clean_events_sql": lambda spark, sf_dir: clean.clean_events_sql(raw_events(spark, sf_dir)),
        "clean_events_coded": _coded_events,
        "event_day": days_of_events,
        "null_profile": lambda spark, sf_dir: clean.null_profile(raw_events(spark, sf_dir)),
    }
    relations = {
        "user_repo": lambda spark, sf_dir: _activity(spark, sf_dir).drop("event_id"),
        "user_repo_coded": lambda spark, sf_dir: clean.user_repo(
            _coded_events(spark, sf_dir)
        ).drop("event_id"),
        "user_repo_star": lambda spark, sf_dir: star_activity(spark, sf_dir).drop("event_id"),
        "repo_topic": lambda spark, sf_dir: topics.repo_topic(_activity(spark, sf_dir)),
        "repo_topic_coded": lambda spark, sf_dir: topics.repo_topic_coded(
            _coded_events(spark, sf_dir)
        ),
        "repo_topic_first": lambda spark, sf_dir: topics.one_topic_per_repo(
            topics.repo_topic_coded(_coded_events(spark, sf_dir))
        ),
        "user_topic_bag": lambda spark, sf_dir: topics.user_topic_bag(
            _activity(spark, sf_dir), topics.repo_topic(_activity(spark, sf_dir))
        ),
        "user_topic_star": lambda spark, sf_dir: topics.user_topic_bag(
            star_activity(spark, sf_dir), star_topics(spark, sf_dir, "p_brand")
        ),
        "user_topic_counts": _coded_counts,
        "user_topic_counts_clean": _counts,
        "user_topic_counts_star": _star_counts,
        "user_topic_counts_joined": lambda spark, sf_dir: topics.user_topic_counts(
            star_activity(spark, sf_dir), star_topics(spark, sf_dir, "p_brand")
        ),
        "user_index": lambda spark, sf_dir: follows.user_index(_activity(spark, sf_dir)),
        "follow_edges": _edges,
        "follow_edges_coded": _coded_edges,
        "popular_users": lambda spark, sf_dir: follows.popular_users(
            _edges(spark, sf_dir), MORE_THAN
        ),
    }
    # Column of the lists, and the lists.
    lists = {
        "user_topic_day": ("topics", lambda s, d: topics.user_topic_day(_counts(s, d))),
        "user_topic_day_coded": (
            "topics",
            lambda s, d: topics.user_topic_day(_coded_counts(s, d)),
        ),
        "user_topic_day_star": ("topics", lambda s, d: topics.user_topic_day(_star_counts(s, d))),
        "topic_user_day": ("users", lambda s, d: topics.topic_user_day(_counts(s, d))),
        "topic_user_day_parts": (
            "users",
            lambda s, d: topics.topic_user_day(_counts(s, d), **SMALL),
        ),
        "topic_user_day_coded": ("users", lambda s, d: topics.topic_user_day(_coded_counts(s, d))),
        "topic_user_day_star": ("users", lambda s, d: topics.topic_user_day(_star_counts(s, d))),
        "topic_user_day_brand_star": (
            "users",
            lambda s, d: topics.topic_user_day(_brand_counts(s, d)),
        ),
        "user_repo_day": ("repos", lambda s, d: topics.user_repo_day(_activity(s, d))),
        "user_repo_day_star": ("repos", lambda s, d: topics.user_repo_day(star_activity(s, d))),
        "user_user": ("follows", lambda s, d: follows.user_user(_edges(s, d))),
        "user_user_coded": ("follows", lambda s, d: follows.user_user(_coded_edges(s, d))),
        "user_user_given": ("follows", lambda s, d: follows.user_user(given_follows(s, d))),
        "user_user_star": ("follows", lambda s, d: follows.user_user(_star_edges(s, d))),
    }
    lookups = {
        "user_follows": lambda spark, sf_dir: serve.user_follows(_edges(spark, sf_dir), USER),
        "ego_network": lambda spark, sf_dir: serve.ego_network(_edges(spark, sf_dir), USER),
        "window_bounds": window_bounds,
        "network_topics": network_topics,
        "network_topics_coded": network_topics_coded,
        "network_topics_star": network_topics_star,
        "network_topics_published": network_topics_published,
        "topic_users": topic_users,
        "topic_users_star": topic_users_star,
        "topic_users_published": topic_users_published,
        "network_topic_users": network_topic_users,
        "topic_user_links": topic_user_links,
        "publish_user_user": publish_user_user,
        "publish_user_topic": publish_user_topic,
        "publish_topic_user": publish_topic_user,
        "publish_user_user_late": publish_user_user_late,
        "publish_user_topic_emptied": publish_user_topic_emptied,
        "publish_user_repo": publish_user_repo,
        "publish_user_user_compacted": publish_user_user_compacted,
        "event_rejects": event_rejects,
        "daily_tables": daily_tables,
        "tables_by_deltas": tables_by_deltas,
        "load_events_stream": load_events_stream,
        "network_topics_requests": network_topics_requests,
        "topic_users_any_window": topic_users_any_window,
        "user_repos_published": user_repos_published,
        "network_topic_users_published": network_topic_users_published,
        "popular_users_given": lambda spark, sf_dir: follows.popular_users(
            given_follows(spark, sf_dir), MORE_THAN
        ),
        "popular_users_sketched": popular_users_sketched,
        "ego_network_hops": ego_network_hops,
        "network_topics_given": network_topics_given,
        "network_topic_users_given": network_topic_users_given,
    }
    as_text = {
        key: lambda spark, sf_dir, name=name, build=build: _text(build(spark, sf_dir), name)
        for key, (name, build) in lists.items()
    }
    return {**events, **relations, **as_text, **lookups}
