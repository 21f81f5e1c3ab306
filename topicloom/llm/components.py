"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.session import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex`` and ``label``, the smallest vertex that links lead to.

    Each round every vertex takes the smallest label among its neighbours, then the label of that
    label, so the number of rounds grows with the logarithm of the longest chain. Rounds are written
    down; only the number of changed labels reaches the driver. A vertex without links is not listed.
    Links that repeat, point to themselves or have a null end change nothing.
    """
    pairs = links.select(F.col(a).alias("v"), F.col(b).alias("u")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()
    )
    edges = saved(pairs.union(pairs.select("u", "v")).distinct(), "edges")
    start = edges.groupBy("v").agg(F.min("u").alias("m"))
    labels = saved(start.select("v", F.least("v", "m").alias("l")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("v").alias("u"), "l"), "u")
            .groupBy("v")
            .agg(F.min("l").alias("m"))
        )
        hop = labels.join(near, "v").select(
            "v", F.col("l").alias("was"), F.least("l", "m").alias("l")
        )
        hop = saved(hop, "hop")
        further = hop.select(F.col("v").alias("l"), F.col("l").alias("m"))
        moved = hop.join(further, "l").select("v", F.least("l", "m").alias("l"), "was")
        moved = saved(moved, "labels")
        if moved.where(F.col("l") != F.col("was")).isEmpty():
            return moved.select(F.col("v").alias("vertex"), F.col("l").alias("label"))
        labels = moved.select("v", "l")
