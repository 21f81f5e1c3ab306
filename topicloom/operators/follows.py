"""The simulated follow graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.functions.text import hash60
from topicloom.operators.lists import bounded_lists
from topicloom.session import saved

# Fixed value: followed users drawn per activity.
DRAWS = 5


def dense_index(rows: DataFrame, order: str) -> DataFrame:
    """The rows with ``idx`` 0, 1, 2, … in the order of a unique column.

    A global ``row_number`` would sort everything in one task. Here the rows are range-sorted
    in parallel and numbered within their partition; adding up the partition sizes, one row per
    partition, gives the offsets. The numbered rows are written before they are counted, so
    that both steps see the same partitions even when tasks run again.
    """
    local = F.monotonically_increasing_id()  # partition number in the bits from 33 up
    numbered = saved(
        rows.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("chunk", F.shiftright(local, 33))
        .withColumn("place", local.bitwiseAND((1 << 33) - 1)),
        "index",
    )
    sizes = numbered.groupBy("chunk").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("chunk", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return (
        numbered.join(F.broadcast(offsets), "chunk")
        .withColumn("idx", F.col("place") + F.col("start"))
        .drop("chunk", "place", "start")
    )


def user_index(activity: DataFrame) -> DataFrame:
    """Each distinct user with a dense index: ``usr, idx``."""
    return dense_index(activity.select("usr").distinct(), "usr")


def activity_index(activity: DataFrame) -> DataFrame:
    """One entry per activity, so that active users are drawn more often: ``usr, idx``."""
    return dense_index(activity.select("event_id", "usr"), "event_id").select("usr", "idx")


def follow_edges(activity: DataFrame, index: DataFrame) -> DataFrame:
    """Five different entries of the index drawn for every activity: ``event_id, usr, follow``.

    The draws are a first position and a step, both hashed from the activity's id. The step is
    small enough that five positions never meet. With a user index the five are different users,
    and the activity's own user may be among them.
    """
    size = index.count()
    if size < DRAWS:
        raise ValueError(f"cannot draw {DRAWS} of {size} users")
    first = hash60(F.concat(F.lit("s"), F.col("event_id").cast("string")))
    step = hash60(F.concat(F.lit("p"), F.col("event_id").cast("string"))) % ((size - 1) // 4) + 1
    positions = [(F.col("first") + i * F.col("step")) % size for i in range(DRAWS)]
    draws = activity.select("event_id", "usr", first.alias("first"), step.alias("step")).select(
        "event_id", "usr", F.explode(F.array(*positions)).alias("idx")
    )
    return draws.join(index.withColumnRenamed("usr", "follow"), "idx").drop("idx")


def follow_counts(edges: DataFrame) -> DataFrame:
    """``usr, follow, n``: edges counted."""
    return edges.groupBy("usr", "follow").agg(F.count(F.lit(1)).alias("n"))


def user_user(edges: DataFrame, **limits) -> DataFrame:
    """User to the list of followed users, from ``usr, follow``; ``n`` counts repeated rows."""
    return bounded_lists(follow_counts(edges), ["usr"], "follow", "follows", **limits)


def popular_users(edges: DataFrame, more_than: int) -> DataFrame:
    """Users with more than that many different followers: ``follow, n``."""
    followers = edges.select("usr", "follow").distinct()
    return (
        followers.groupBy("follow")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > more_than)
    )


# Registers of a sketch are 2**12: estimates are off by 1.04 / 2**6 of the number as a standard error.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def follower_sketches(edges: DataFrame) -> DataFrame:
    """``follow, sketch``: the different followers as a sketch of some kilobytes at most.

    Sketches of several runs or days merge into that of all their edges, so a count over runs reads a row
    per followed user and run, not the edges. Edges with a null end count for nothing.
    """
    whole = edges.where(F.col("usr").isNotNull() & F.col("follow").isNotNull())
    sketch = F.hll_sketch_agg(F.col("usr").cast("string"), F.lit(SKETCH_BITS)).alias("sketch")
    return whole.groupBy("follow").agg(sketch)


def estimated_followers(sketches: DataFrame) -> DataFrame:
    """``follow, estimate``: the followers of all sketches of a user together.

    The standard error is ``SKETCH_ERROR`` of the number; a few dozen followers are counted exactly.
    ``popular_users`` is the exact count.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy("follow").agg(merged.alias("estimate"))
