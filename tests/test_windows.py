"""Many windows at once: ranges, requests, and their plans."""

import io
import random
from collections import Counter, defaultdict
from contextlib import redirect_stdout
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from topicloom.operators import serve
from topicloom.operators.windows import (
    first_users,
    in_ranges,
    network_topics_requests,
    topic_users_requests,
    window_ranges,
)

BEGIN = date(1969, 12, 1)


def day(k):
    return BEGIN + timedelta(days=k)


@pytest.mark.parametrize("levels", [1, 3, 13])
def test_ranges_are_the_window(spark, levels):
    """Every day strictly inside is in exactly one range, on both sides of 1970, and no other day is."""
    rng = random.Random(levels)
    windows = [(k, day(a), day(a + n)) for k, (a, n) in enumerate((rng.randrange(60), rng.randrange(-2, 300)) for _ in range(60))]
    windows += [(60, None, day(3)), (61, day(3), None)]
    asked = spark.createDataFrame(windows, "request int, start date, end date")
    ranges = asked.select("request", F.inline(window_ranges(F.col("start"), F.col("end"), levels))).collect()
    found = Counter()
    for r in ranges:
        first = r.block << r.level
        found.update((r.request, d) for d in range(first, first + (1 << r.level)))
    expected = Counter(
        (k, (a - date(1970, 1, 1)).days + n)
        for k, a, b in windows if a and b for n in range(1, (b - a).days)
    )
    assert found == expected
    if levels == 13:
        assert max(Counter((r.request, r.level) for r in ranges).values()) <= 2


def test_rows_are_in_one_range_of_each_level(spark):
    rows = spark.createDataFrame([(day(k),) for k in (0, 40, 77)] + [(None,)], "day date")
    found = in_ranges(rows, 5).collect()
    for r in found:
        number = (r.day - date(1970, 1, 1)).days
        assert r.block << r.level <= number < (r.block + 1) << r.level
    assert Counter(r.level for r in found) == {k: 3 for k in range(5)}


@pytest.fixture(scope="module")
def made(spark):
    """A user whom everybody follows, users nobody follows, repeated rows and nulls."""
    rng = random.Random(4)
    rows = [(f"u{rng.randrange(12)}", day(rng.randrange(60)), f"t{rng.randrange(9)}") for _ in range(400)]
    rows += [rows[0]] * 3 + [(None, day(1), "t0"), ("u1", None, "t1"), ("u2", day(3), None)]
    edges = [(f"u{k}", "u0") for k in range(12)] + [(f"u{rng.randrange(12)}", f"u{rng.randrange(12)}") for _ in range(30)]
    edges += [edges[0], ("u1", None), (None, "u1")]
    asked = [(k, f"u{rng.randrange(13)}", day(a), day(a + rng.randrange(0, 40))) for k, a in enumerate(rng.randrange(60) for _ in range(50))]
    asked += [(50, None, day(1), day(9)), (51, "u1", None, day(9)), (None, "u1", day(1), day(9)), asked[0]]
    return (
        spark.createDataFrame(rows, "usr string, day date, topic string"),
        spark.createDataFrame(edges, "usr string, follow string"),
        spark.createDataFrame(asked, "request int, usr string, start date, end date"),
        rows, edges, asked,
    )


@pytest.mark.parametrize("floor", [5, 100_000])
def test_network_topics_of_many_requests(made, floor):
    user_topics, edges, requests, rows, links, asked = made
    follows = defaultdict(set)
    for usr, follow in links:
        if usr and follow:
            follows[usr].add(follow)
    expected = {
        (k, t) for k, usr, a, b in asked if k is not None and usr and a
        for u, d, t in rows if u in follows[usr] and d and a < d < b
    }
    found = network_topics_requests(user_topics, edges, requests, floor=floor).collect()
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_one_request_is_the_lookup(made):
    user_topics, edges, requests, *_ = made
    for r in requests.where("request < 5").collect():
        one = serve.network_topics(user_topics, serve.user_follows(edges, r.usr), r.start, r.end)
        many = network_topics_requests(user_topics, edges, requests.where(F.col("request") == r.request))
        assert {x.topic for x in one.collect()} == {x.topic for x in many.collect()}


def test_topic_users_of_many_windows(made):
    user_topics, _, requests, rows, _, asked = made
    topics = requests.withColumn("topic", F.concat(F.lit("t"), (F.col("request") % 9).cast("string"))).drop("usr")
    expected = []
    for k, _, a, b in dict.fromkeys(asked):
        if k is None or a is None:
            continue
        first = {}
        for u, d, t in rows:
            if t == f"t{k % 9}" and u and d and a < d < b:
                first[u] = min(d, first.get(u, d))
        expected += [(k, u, first[u]) for u in sorted(first, key=lambda u: (first[u], u))[:5]]
    found = topic_users_requests(first_users(user_topics), topics).collect()
    assert Counter(map(tuple, found)) == Counter(expected)


def test_no_tables(made):
    user_topics, edges, requests, *_ = made
    none = user_topics.limit(0)
    assert network_topics_requests(none, edges, requests).isEmpty()
    assert network_topics_requests(user_topics, edges, requests.limit(0)).isEmpty()
    assert first_users(none).isEmpty()


def test_first_users_are_cut_before_the_shuffle(made):
    out = io.StringIO()
    with redirect_stdout(out):
        first_users(made[0]).explain()
    assert out.getvalue().count("WindowGroupLimit") == 2  # Partial and Final
