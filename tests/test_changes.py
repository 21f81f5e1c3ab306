"""Changed events and arriving files against full runs."""

import random
from collections import Counter
from datetime import date

import pytest

from topicloom.operators import topics
from topicloom.operators.deltas import delta_counts, signed_activity, touched_counts
from topicloom.plans.changes import apply_changes
from topicloom.sources.tables import day_log, publish_days, read_days
from topicloom.streaming import load_new_files

DAYS = [date(2018, 1, d) for d in range(1, 6)]
EVENT = "event_id long, usr string, repo string, day date"


def drawn(rng, number):
    return (number, f"u{rng.randrange(5)}", rng.choice(["r1", "r2", "r3", None]), rng.choice(DAYS))


@pytest.fixture(scope="module")
def changed(spark):
    """Stored events, changes of all kinds, and the events as they should be."""
    rng = random.Random(8)
    stored = {k: drawn(rng, k) for k in range(60)}
    right, changes = dict(stored), []
    for k in rng.sample(range(60), 25):
        if k % 3 == 0:
            changes.append((*stored[k], True))
            del right[k]
        elif k % 3 == 1:
            right[k] = drawn(rng, k)
            changes.append((*right[k], False))
        else:
            changes.append((*stored[k], False))  # as it is
    for k in range(60, 70):
        right[k] = drawn(rng, k)
        changes.append((*right[k], False))
    changes += [(99, "u1", "r1", DAYS[0], True), (None, "u1", "r1", DAYS[0], False), changes[0]]
    return stored, changes, right


def test_counts_by_deltas(spark, changed):
    stored, changes, right = changed
    before = spark.createDataFrame(list(stored.values()), EVENT)
    after = spark.createDataFrame(list(right.values()), EVENT)
    frame = spark.createDataFrame(changes, f"{EVENT}, withdrawn boolean")
    relation = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "a"), ("r2", "a")], "repo string, topic string")
    signed = signed_activity(before, frame)
    assert all(r.sign in (-1, 1) for r in signed.collect())
    delta = delta_counts(signed, relation)
    old, new = (topics.user_topic_counts(x, relation) for x in (before, after))
    touched = touched_counts(old, delta, ["usr", "day"])
    keys = delta.select("usr", "day").distinct()
    expected = new.join(keys, ["usr", "day"], "left_semi").select("usr", "day", "topic", "n")
    assert Counter(map(tuple, touched.select("usr", "day", "topic", "n").collect())) == Counter(map(tuple, expected.collect()))
    assert signed_activity(before, frame.limit(0)).isEmpty()


def test_changes_are_published_once(spark, changed, tmp_path):
    stored, changes, right = changed
    out = str(tmp_path)
    before = spark.createDataFrame(list(stored.values()), EVENT)
    relation = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r3", "a")], "repo string, topic string")
    counts = topics.user_topic_counts(before, relation)
    publish_days(before, f"{out}/activity", "usr", buckets=2)
    publish_days(counts, f"{out}/counts", "usr", buckets=2)
    publish_days(topics.user_topic_day(counts), f"{out}/usertopic", "usr", buckets=2)
    publish_days(topics.topic_user_day(counts), f"{out}/topicuser", "topic", buckets=2)
    publish_days(topics.user_repo_day(before), f"{out}/userrepo", "usr", buckets=2)
    frame = spark.createDataFrame(changes, f"{EVENT}, withdrawn boolean")
    done = apply_changes(spark, out, frame, relation)
    assert set(done) == {"usertopic", "topicuser", "userrepo", "counts", "activity"} and min(done.values()) > 0
    activity = read_days(spark, f"{out}/activity").select("event_id", "usr", "repo", "day")
    assert sorted(map(tuple, activity.collect())) == sorted(right.values())
    after = spark.createDataFrame(list(right.values()), EVENT)
    new = topics.user_topic_counts(after, relation)
    for table, lists in (
        ("usertopic", topics.user_topic_day(new)),
        ("topicuser", topics.topic_user_day(new)),
        ("userrepo", topics.user_repo_day(after)),
    ):
        found = read_days(spark, f"{out}/{table}").select(*lists.columns)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, lists.collect())), table
    logs = day_log(spark, f"{out}/usertopic").collect()
    assert apply_changes(spark, out, frame, relation) == {}
    assert sorted(day_log(spark, f"{out}/usertopic").collect()) == sorted(logs)


def test_files_are_loaded_as_they_come(spark, tmp_path):
    files, out, checkpoint = (str(tmp_path / name) for name in ("files", "out", "checkpoint"))

    def drop(name, *numbers, usr="a"):
        (tmp_path / "files").mkdir(exist_ok=True)
        line = '{{"event_id":{0},"type":"ForkEvent","actor":{{"login":"{1}"}},"repo":{{"name":"r{0}"}},"created_at":"2018-01-0{2} 00:00:00 UTC"}}\n'
        (tmp_path / "files" / name).write_text("".join(line.format(k, usr, 1 + k % 2) for k in numbers))

    def loaded():
        return sorted((r.event_id, r.usr) for r in read_days(spark, f"{out}/activity").collect())

    drop("1.json", 1, 2, 3, 3)
    load_new_files(spark, files, out, checkpoint, buckets=2)
    assert loaded() == [(1, "a"), (2, "a"), (3, "a")]
    versions = spark.read.parquet(f"{out}/activity_days").count()
    load_new_files(spark, files, out, checkpoint, buckets=2)  # nothing new: nothing is published
    assert spark.read.parquet(f"{out}/activity_days").count() == versions
    drop("2.json", 3, 4, usr="b")
    load_new_files(spark, files, out, checkpoint, buckets=2)
    assert loaded() == [(1, "a"), (2, "a"), (3, "b"), (4, "b")]
    load_new_files(spark, files, out, str(tmp_path / "again"), files=1, buckets=2)  # all once more, file by file
    assert {k for k, _ in loaded()} == {1, 2, 3, 4} and len(loaded()) == 4
