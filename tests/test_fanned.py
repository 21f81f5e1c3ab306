"""Many rows made of few: tasks take a bounded number of rows, however many there are."""

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from topicloom.operators import topics

DAYS = [date(2018, 1, d) for d in (1, 2, 3)]


@pytest.fixture(scope="module")
def relations(spark):
    """400 activities of 40 users, some of them twice, and 3 repositories with 60 topics each."""
    rows = [(i, f"u{i * 7 % 40}", f"r{i % 4}", DAYS[i % 3]) for i in range(400)]
    rows += [*rows[:50], (900, "u1", None, DAYS[0]), (901, None, "r1", DAYS[0]), (902, "u1", "r1", None)]
    activity = spark.createDataFrame(rows, "event_id long, usr string, repo string, day date")
    pairs = [(f"r{r}", f"t{t}") for r in range(3) for t in range(60)]
    relation = spark.createDataFrame([*pairs, *pairs[:30], ("r9", "t1"), (None, "t2"), ("r1", None)], "repo string, topic string")
    return activity, relation


def bag(counts):
    return Counter({(r.usr, r.day, r.topic): r.n for r in counts.collect()})


@pytest.mark.parametrize("sent", [100_000, 10])
def test_fanned_counts(relations, monkeypatch, sent):
    activity, relation = relations
    monkeypatch.setattr(topics, "TASK_ROWS", 500)
    monkeypatch.setattr(topics, "SENT_ROWS", sent)
    present = activity.where("usr IS NOT NULL AND day IS NOT NULL")
    found = topics.user_topic_counts_fanned(activity, relation)
    assert bag(found) == bag(topics.user_topic_counts(present, relation))
    assert len(found.collect()) == len(bag(found))


def test_fanned_counts_are_made_in_tasks_of_bounded_size(relations, monkeypatch):
    activity, relation = relations
    monkeypatch.setattr(topics, "TASK_ROWS", 500)
    found = topics.user_topic_counts_fanned(activity, relation)
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 8 and max(r["count"] for r in sizes) < 4 * 500  # 8 shuffle partitions
