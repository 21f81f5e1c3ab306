"""Edge rows, invariants and window edges."""

import hashlib
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from topicloom.functions.text import (
    event_day,
    hash32,
    hash60,
    in_window,
    picker_day,
    picker_text,
)
from topicloom.functions.vocabulary import TOPICS, topic_vocabulary
from topicloom.operators import clean, follows, network, serve, topics
from topicloom.sources.events import EVENT_SCHEMA
from topicloom.sources.testdata import raw_events

SF_DIR = "/root/testdata/sf0.001"

# type, login, repo, time; the login or repo "-" stands for a struct whose field is null.
EDGE_ROWS = [
    ("ForkEvent", "a", "r1", "2018-01-02 03:04:05 UTC"),
    ("ForkEvent", None, "r1", "2018-01-02 03:04:05 UTC"),
    ("ForkEvent", "b", None, "2018-01-03 03:04:05 UTC"),
    ("CommitCommentEvent", "c", None, "2018-01-03 03:04:05 UTC"),
    ("CommitCommentEvent", "c", "r1", "2018-1-3 03:04:05 UTC"),
    ("PushEvent", "c", "r1", "2018-01-03 03:04:05 UTC"),
    ("ForkEvent", "d", "r2", None),
    ("ForkEvent", "d", "r2", "2018-01-03T03:04:05Z"),
    ("ForkEvent", "-", "r2", "2018-01-03 03:04:05 UTC"),
    ("ForkEvent", "e", "-", "2018-01-03 03:04:05 UTC"),
    ("ForkEvent", "f", "r3", "no date"),
]


def struct(value):
    return None if value is None else (None if value == "-" else value,)


@pytest.fixture(scope="module")
def edge_events(spark):
    rows = [
        (i, kind, struct(login), struct(repo), time)
        for i, (kind, login, repo, time) in enumerate(EDGE_ROWS)
    ]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


@pytest.fixture(scope="module")
def activity(spark):
    return clean.user_repo(clean.clean_events(raw_events(spark, SF_DIR))).persist()


@pytest.fixture(scope="module")
def coded(spark):
    return clean.clean_events_coded(raw_events(spark, SF_DIR)).persist()


def ids(df):
    return sorted(row.event_id for row in df.collect())


def test_clean_filters(edge_events):
    assert ids(clean.clean_events(edge_events)) == [0, 4, 7, 10]
    assert ids(clean.clean_events_sql(edge_events)) == [0, 4, 7, 10]
    assert ids(clean.clean_events_coded(edge_events)) == [0, 1, 2, 4, 7, 8, 9, 10]


def test_days_of_edge_rows(edge_events):
    days = {r.event_id: r.day for r in clean.user_repo(clean.clean_events(edge_events)).collect()}
    assert days == {0: date(2018, 1, 2), 4: date(2018, 1, 3), 7: date(2018, 1, 3)}


def test_null_profile_counts_times_that_are_no_date(edge_events):
    nulls = {r["column"]: (r.nulls, r.rows) for r in clean.null_profile(edge_events).collect()}
    assert nulls == {"login": (2, 10), "repo": (3, 10), "created_at": (1, 10), "day": (2, 10)}


def test_coded_user_repo_keeps_null_repos(edge_events):
    rows = clean.user_repo(clean.clean_events_coded(edge_events)).collect()
    assert Counter(r.usr for r in rows) == Counter({"a": 1, "b": 1, "c": 1, "d": 1, "e": 1})
    assert {r.usr for r in rows if r.repo is None} == {"b", "e"}


@pytest.mark.parametrize(
    "text, day",
    [
        ("2018-01-02 03:04:05 UTC", date(2018, 1, 2)),
        ("2018-1-2 03:04:05", date(2018, 1, 2)),
        ("2018-12-31T23:59:59Z", date(2018, 12, 31)),
        ("2018-02-30 00:00:00", None),
        ("", None),
        (None, None),
    ],
)
def test_event_day(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(event_day(F.col("t"))).first()[0] == day


def test_picker_text_round_trip(spark):
    df = spark.createDataFrame([(date(2018, 1, 1),), (date(2020, 2, 29),)], "d date")
    text = df.select(picker_text(F.col("d")).alias("t"))
    assert [r.t for r in text.collect()] == ["Mon Jan 01 2018", "Sat Feb 29 2020"]
    assert [r[0] for r in text.select(picker_day(F.col("t"))).collect()] == [
        date(2018, 1, 1),
        date(2020, 2, 29),
    ]


def test_window_is_open_at_both_ends(spark):
    days = spark.createDataFrame([(date(2018, 1, d),) for d in range(1, 6)], "day date")
    inside = days.where(in_window(F.col("day"), date(2018, 1, 2), date(2018, 1, 4)))
    assert [r.day for r in inside.collect()] == [date(2018, 1, 3)]


def test_vocabulary(spark):
    rows = topic_vocabulary(spark).collect()
    assert [(r.topic_id, r.topic) for r in rows] == list(enumerate(TOPICS))
    assert len(set(TOPICS)) == 177


def test_fixture_sizes(spark, activity, coded):
    coded_activity = clean.user_repo(coded)
    assert coded.count() == 383 and coded_activity.count() == 368
    assert activity.count() == 360
    assert topics.repo_topic(activity).count() == 98
    assert topics.repo_topic_coded(coded).count() == 375
    assert topics.user_topic_counts(activity, topics.repo_topic(activity)).count() == 357
    counts = topics.user_topic_counts(coded_activity, topics.repo_topic_coded(coded))
    assert (counts.count(), counts.agg(F.sum("n")).first()[0]) == (1626, 1678)


def test_counts_equal_counted_bag(activity, coded):
    for rows, repo_topics in (
        (activity, topics.repo_topic(activity)),
        (clean.user_repo(coded), topics.repo_topic_coded(coded)),
    ):
        bag = Counter(tuple(r) for r in topics.user_topic_bag(rows, repo_topics).collect())
        for count_first in (False, True):
            counts = topics.user_topic_counts(rows, repo_topics, count_first).collect()
            assert {(r.usr, r.day, r.topic): r.n for r in counts} == bag


def test_repository_with_many_events_and_topics(spark):
    day = date(2018, 1, 1)
    rows = spark.createDataFrame(
        [(i, "a", "r", day) for i in range(3)], "event_id long, usr string, repo string, day date"
    )
    topics_of_r = spark.createDataFrame([("r", "t")] * 3, "repo string, topic string")
    assert topics.user_topic_bag(rows, topics_of_r).count() == 9
    assert topics.user_topic_counts(rows, topics_of_r).collect()[0].n == 9


def test_dense_index_is_the_rank(spark):
    users = spark.range(2_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("usr"))
    index = follows.dense_index(users.repartition(7), "usr")
    expected = sorted(f"u{i}" for i in range(2_000))
    assert {r.usr: r.idx for r in index.collect()} == {u: i for i, u in enumerate(expected)}


@pytest.mark.parametrize("users", [5, 6, 9, 50])
def test_five_different_draws(spark, users):
    rows = spark.range(400).select(F.col("id").alias("event_id"), (F.col("id") % users).alias("usr"))
    edges = follows.follow_edges(rows, follows.user_index(rows)).collect()
    drawn = {}
    for edge in edges:
        drawn.setdefault(edge.event_id, set()).add(edge.follow)
    assert len(edges) == 2_000
    assert len(drawn) == 400 and all(len(d) == 5 for d in drawn.values())


def test_hashes(spark):
    digest = hashlib.md5(b"17").hexdigest()
    row = spark.range(17, 18).select(hash32(F.col("id")), hash60(F.col("id"))).first()
    assert tuple(row) == (int(digest[:8], 16), int(digest[:15], 16))


def test_too_few_users(spark):
    rows = spark.range(40).select(F.col("id").alias("event_id"), (F.col("id") % 4).alias("usr"))
    with pytest.raises(ValueError, match="cannot draw 5 of 4 users"):
        follows.follow_edges(rows, follows.user_index(rows))


def test_activity_index_weighs_by_activity(spark):
    rows = spark.range(3_000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") < 2_000, 0).otherwise(F.col("id")).alias("usr")
    )
    edges = follows.follow_edges(rows, follows.activity_index(rows))
    share = edges.agg(F.avg((F.col("follow") == 0).cast("int"))).first()[0]
    assert 0.63 < share < 0.70


def test_flagship_sizes(spark):
    from topicloom.plans.catalog import network_topics, network_topics_coded

    assert network_topics(spark, SF_DIR).count() == 25
    assert network_topics_coded(spark, SF_DIR).count() == 94


def test_unknown_user_has_no_network(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c")], "usr string, follow string")
    assert serve.user_follows(edges, "x").count() == 0
    assert sorted(r.follow for r in serve.user_follows(edges, "a").collect()) == ["b", "c"]


def test_lookups(spark):
    day = [date(2018, 1, d) for d in range(1, 9)]
    rows = [("b", day[1], "T"), ("b", day[2], "T"), ("c", day[4], "S"), ("d", day[3], "T"), ("a", day[3], "T")]
    rows += [(f"z{i}", day[5], "T") for i in range(9)] + [("early", day[0], "T"), ("late", day[7], "T")]
    user_topics = spark.createDataFrame(rows, "usr string, day date, topic string")
    followed = spark.createDataFrame([("b",), ("c",), ("late",), (None,)], "follow string")
    start, end = day[0], day[7]
    found = serve.network_topics(user_topics, followed, start, end).collect()
    assert sorted(r.topic for r in found) == ["S", "T"]
    first = serve.topic_users(user_topics, "T", start, end).collect()
    assert [(r.usr, r.first_day) for r in first] == [
        ("b", day[1]), ("a", day[3]), ("d", day[3]), ("z0", day[5]), ("z1", day[5])
    ]
    mine = serve.network_topic_users(user_topics, followed, "T", start, end)
    assert [r.usr for r in mine.collect()] == ["b"]
    link = serve.topic_user_links(mine).first().link
    assert link == "https://github.com/b"


def test_popular_users(spark):
    edges = [(f"u{i}", "star") for i in range(7)] + [("u1", "star"), ("u1", "other")]
    df = spark.createDataFrame(edges, "usr string, follow string")
    assert [tuple(r) for r in follows.popular_users(df, 5).collect()] == [("star", 7)]


@pytest.mark.parametrize("floor", [2, 100_000])
def test_ego_network_hops(spark, floor):
    """A hub, a cycle, a chain longer than the steps, a start without edges, null ends."""
    edges = [("a", "b"), ("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", "g")]
    edges += [("b", f"h{k}") for k in range(9)] + [("h1", "d"), ("a", None), (None, "a"), ("x", "x")]
    df = spark.createDataFrame(edges, "usr string, follow string")
    starts = spark.createDataFrame([("a",), ("x",), ("lonely",), (None,), ("a",)], "usr string")
    found = {(r.start, r.usr): r.distance for r in network.ego_network_hops(df, starts, 4, floor=floor).collect()}
    expected = {("a", k): d for k, d in {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4}.items()}
    expected |= {("a", f"h{k}"): 2 for k in range(9)} | {("x", "x"): 0, ("lonely", "lonely"): 0}
    assert found == expected
    assert network.ego_network_hops(df, starts.limit(0), 4).isEmpty()


def test_follower_sketches_merge(spark):
    """Many followers within the stated error, few exactly, over runs that overlap."""
    edges = spark.range(30_000).select(
        F.col("id").alias("usr"), F.when(F.col("id") % 10 < 9, F.lit("star")).otherwise(F.lit("b")).alias("follow")
    )
    edges = edges.unionByName(spark.createDataFrame([(1, "c"), (1, "c"), (2, "c"), (None, "c")], "usr long, follow string"))
    runs = [follows.follower_sketches(edges.where(F.col("usr") % 4 >= k)) for k in range(3)]
    merged = follows.estimated_followers(runs[0].unionByName(runs[1]).unionByName(runs[2]))
    found = {r.follow: r.estimate for r in merged.collect()}
    assert found["c"] == 2
    assert abs(found["star"] / 27_000 - 1) < 4 * follows.SKETCH_ERROR > abs(found["b"] / 3_000 - 1)


def test_inverse_relation(activity):
    counts = topics.user_topic_counts(activity, topics.repo_topic(activity)).persist()
    by_user = Counter()
    for r in topics.user_topic_day(counts).collect():
        for topic, n in zip(r.topics, r.counts):
            by_user[r.usr, r.day, topic] += n
    by_topic = Counter()
    for r in topics.topic_user_day(counts).collect():
        for usr, n in zip(r.users, r.counts):
            by_topic[usr, r.day, r.topic] += n
    assert by_user == by_topic and sum(by_user.values()) == 360
