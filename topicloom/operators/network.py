"""The network round a user beyond those they follow themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.operators.skew import skew_join
from topicloom.session import saved


def ego_network_hops(edges: DataFrame, users: DataFrame, hops: int, **skew) -> DataFrame:
    """Users within ``hops`` follow steps of a start: ``start, usr, distance``, the fewest steps.

    ``users`` is a relation ``usr`` of one or more starts, each of which is in its own network at distance 0.
    Every step follows the edges of the users found last and drops those found before, so an edge is
    followed once for each start. The edges of a user who follows very many are salted. Steps are
    written down; whether one has found somebody new is all that the driver learns. Repeated edges and
    those with a null end change nothing; neither does a start without edges.
    """
    whole = edges.where(F.col("usr").isNotNull() & F.col("follow").isNotNull())
    links = saved(whole.select("usr", "follow").distinct(), "links")
    starts = users.where(F.col("usr").isNotNull()).select("usr").distinct()
    last = saved(starts.select(F.col("usr").alias("start"), "usr", F.lit(0).alias("distance")), "hop")
    found = [last]
    for step in range(1, hops + 1):
        reached = skew_join(links, last.select("start", "usr"), "usr", **skew)
        reached = reached.select("start", F.col("follow").alias("usr")).distinct()
        known = reduce(DataFrame.unionByName, found).select("start", "usr")
        new = reached.join(known, ["start", "usr"], "left_anti")
        last = saved(new.withColumn("distance", F.lit(step)), "hop")
        if last.isEmpty():
            break
        found.append(last)
    return reduce(DataFrame.unionByName, found)
