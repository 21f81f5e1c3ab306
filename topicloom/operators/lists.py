"""Value lists per key, in parts of bounded length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.functions.nulls import all_present
from topicloom.session import saved

MAX_ITEMS = 10_000
# Rows that one task takes without trouble.
TASK_ROWS = 500_000


def bounded_lists(
    counted: DataFrame, keys: Sequence[str], item: str, name: str, max_items: int = MAX_ITEMS
) -> DataFrame:
    """Lists per key from rows ``keys, item, n`` that hold each item of a key once.

    A list is a bag: ``name`` has each item once, in order, and ``counts`` how often it occurs;
    ``n`` is the sum of the part's counts. No array is longer than ``max_items``: part k holds the
    items from place k * ``max_items`` on, so parts depend on the key's own items alone.

    The rows are written once and the items of each key counted. The rows of a key with one part are sent
    to one task. A key with several may hold any share of the rows, so these are dealt into ranges
    of key and item, as many as are needed: they are numbered by their place in their range, to which what a
    key has in earlier ranges, one row per range, is added. Tasks take about ``TASK_ROWS`` rows each,
    however many there are.
    """
    present = counted.where(all_present(*keys)).select(*keys, item, "n")
    rows = saved(present, "list_rows")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > max_items)
    long = saved(sizes, "long_keys")
    total = rows.count()
    of_long = long.agg(F.sum("size")).first()[0] or 0
    short = rows.join(long.drop("size"), list(keys), "left_anti")
    short = short.repartition(_tasks(total - of_long), *keys).withColumn("part", F.lit(0).cast("bigint"))
    parted = _parted(rows.join(long.drop("size"), list(keys), "left_semi"), keys, item, max_items, of_long)
    bag = F.sort_array(F.collect_list(F.struct(item, "n"))).alias("bag")

    def lists(of: DataFrame) -> DataFrame:
        return of.groupBy(*keys, "part").agg(bag, F.sum("n").alias("total"))

    return lists(short).unionByName(lists(parted)).select(
        *keys,
        "part",
        F.col(f"bag.{item}").alias(name),
        F.col("bag.n").alias("counts"),
        F.col("total").alias("n"),
    )


def _tasks(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def _parted(
    rows: DataFrame, keys: Sequence[str], item: str, max_items: int, total: int
) -> DataFrame:
    """The rows with their ``part``, those of a part in one task."""
    tasks = _tasks(total)
    ranges = (
        rows.repartitionByRange(tasks, *keys, item)
        .sortWithinPartitions(*keys, item)
        .withColumn("chunk", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id())  # rises by one from row to row of a range
    )
    dealt = saved(ranges, "lists")  # ranges come from a sample and are read twice
    before = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "chunk")
        .agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
        .withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .drop("size")
    )
    starts = saved(starts, "list_starts")
    part = F.floor((F.col("start") + F.col("at") - F.col("first")) / F.lit(max_items))
    return (
        dealt.join(starts, [*keys, "chunk"])
        .select(*keys, item, "n", part.cast("bigint").alias("part"))
        .repartition(tasks, *keys, "part")
    )


def unnest(lists: DataFrame, name: str, item: str) -> DataFrame:
    """The rows behind published lists: ``bounded_lists`` undone."""
    other = [c for c in lists.columns if c not in (name, "counts", "n", "part")]
    pairs = F.explode(F.arrays_zip(F.col(name).alias(item), F.col("counts").alias("n")))
    return lists.select(*other, pairs.alias("pair")).select(*other, f"pair.{item}", "pair.n")
