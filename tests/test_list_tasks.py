"""Lists are made in tasks that take a bounded number of rows, however many there are."""

import pytest
from pyspark.sql import functions as F

from topicloom.operators import lists


@pytest.mark.parametrize("max_items", [7, 50, 1000])
def test_lists_are_made_in_tasks_of_bounded_size(spark, monkeypatch, max_items):
    monkeypatch.setattr(lists, "TASK_ROWS", 500)
    v = F.col("id")
    key = F.when(v < 3000, F.concat(F.lit("k"), (v % 200).cast("string"))).otherwise(F.lit("hot"))
    counted = spark.range(9000).select(key.alias("key"), v.alias("v"), (v % 5 + 1).alias("n"))
    found = lists.bounded_lists(counted, ["key"], "v", "vs", max_items=max_items).cache()
    expected = {}
    for r in counted.collect():
        expected.setdefault(r.key, []).append((r.v, r.n))
    assert found.count() == sum(-(-len(x) // max_items) for x in expected.values())
    for r in found.collect():
        own = sorted(expected[r.key])[r.part * max_items : (r.part + 1) * max_items]
        assert [*zip(r.vs, r.counts, strict=True)] == own and r.n == sum(n for _, n in own)
    tasks = found.groupBy(F.spark_partition_id()).agg(F.sum(F.size("vs")).alias("rows")).collect()
    assert max(t.rows for t in tasks) < 4 * max(500, max_items)
    assert max_items == 1000 or len(tasks) > 8
