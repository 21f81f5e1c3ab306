"""Salted joins and cut lists on random tables, against plain Python."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from topicloom.operators.lists import bounded_lists, unnest
from topicloom.operators.skew import skew_join

KEYS = st.sampled_from(["hot", "hot", "hot", "a", "b", None])
LEFT = st.lists(st.tuples(KEYS, st.integers(0, 9)), min_size=1, max_size=60)
RIGHT = st.lists(st.tuples(KEYS, st.sampled_from("xyz")), min_size=1, max_size=6)
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@FEW
@given(left=LEFT, right=RIGHT, floor=st.integers(1, 20))
def test_skew_join(spark, left, right, floor):
    joined = skew_join(
        spark.createDataFrame(left, "key string, v long"),
        spark.createDataFrame(right, "key string, w string"),
        "key",
        floor=floor,
    )
    expected = Counter((k, v, w) for k, v in left for q, w in right if k is not None and k == q)
    assert Counter(tuple(r) for r in joined.select("key", "v", "w").collect()) == expected


@FEW
@given(rows=LEFT, max_items=st.integers(1, 5))
def test_bounded_lists(spark, rows, max_items):
    bag = Counter(rows)
    counted = spark.createDataFrame([(k, v, n) for (k, v), n in bag.items()], "key string, v long, n long")
    lists = bounded_lists(counted, ["key"], "v", "vs", max_items=max_items).persist()
    assert all(0 < len(r.vs) <= max_items for r in lists.collect())
    back = {(r.key, r.v): r.n for r in unnest(lists, "vs", "v").collect()}
    assert back == {(k, v): n for (k, v), n in bag.items() if k is not None}
    lists.unpersist()
