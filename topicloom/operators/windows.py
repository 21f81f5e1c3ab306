"""Questions about many windows of days at once.

Days are put together in ranges of 1, 2, 4, … days that begin at multiples of their length. Every window is
the union of at most two ranges of each length that do not overlap, so a question about any window is an
equi-join on a few ranges with what was summed up for each range before: no condition on days is left for
the join, and a row of the result is not made once for every day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.operators.serve import SHOWN
from topicloom.operators.skew import skew_join

# Ranges of up to 2**12 days; longer windows take several of the longest.
LEVELS = 13


def window_ranges(start: Column, end: Column, levels: int = LEVELS) -> Column:
    """The ranges ``level, block`` that make up the days strictly between two days, as an array.

    Block b of a level has the days from b * 2**level since 1970 up to (b + 1) * 2**level, exclusive. A window
    without a day between its ends has none; one with a null end gives null.
    """
    low, high = F.unix_date(start) + 1, F.unix_date(end)

    def blocks(level: int) -> Column:
        first = -F.shiftright(-low, level)  # rounded up
        stop = F.shiftright(high, level)

        def one(block: Column) -> Column:
            return F.struct(F.lit(level).alias("level"), block.cast("int").alias("block"))

        if level == levels - 1:
            rest = F.sequence(first, F.greatest(first, stop - 1))
            found = F.transform(rest, one)
        else:
            odd = (F.when(first % 2 != 0, one(first)), F.when(stop % 2 != 0, one(stop - 1)))
            found = F.array_compact(F.array(*odd))
        return F.when(first < stop, found).otherwise(F.filter(found, lambda _: F.lit(False)))

    every = F.flatten(F.array(*(blocks(level) for level in range(levels))))
    return F.when(start.isNotNull() & end.isNotNull(), every)


def in_ranges(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Each row once for every range that has its ``day``, with ``level`` and ``block``."""
    every = F.array(
        *(
            F.struct(F.lit(k).alias("level"), F.shiftright(F.unix_date("day"), k).alias("block"))
            for k in range(levels)
        )
    )
    return rows.where(F.col("day").isNotNull()).select("*", F.inline(every))


def range_topics(user_topics: DataFrame) -> DataFrame:
    """The different topics of each user in each range: ``usr, level, block, topic``.

    Repeated rows meet on the map side; all levels together have at most twice the rows of the days.
    """
    return in_ranges(user_topics.select("usr", "day", "topic")).drop("day").distinct()


def asked_ranges(requests: DataFrame) -> DataFrame:
    """Each request once for every range of its window ``start, end``."""
    return requests.select("*", F.inline(window_ranges(F.col("start"), F.col("end")))).drop("start", "end")


def network_topics_requests(
    user_topics: DataFrame, edges: DataFrame, requests: DataFrame, **skew
) -> DataFrame:
    """``network_topics`` for many requests ``request, usr, start, end``: the different ``request, topic``.

    A user who is followed by very many of those who ask makes a hot key; its requests are salted, and the
    topics of a range, at most the vocabulary, are repeated for each salt. A request that finds nothing, or has a
    null user or window, gives no rows. A request number that comes twice asks for both.
    """
    followed = edges.select("usr", "follow").where(F.col("follow").isNotNull()).distinct()
    asked = skew_join(followed, asked_ranges(requests), "usr", **skew)

    def key(usr: str) -> Column:
        return F.struct(F.col(usr).alias("usr"), "level", "block").alias("range")

    asked = asked.where(F.col("request").isNotNull()).select("request", key("follow")).distinct()
    known = range_topics(user_topics).where(F.col("usr").isNotNull()).select(key("usr"), "topic")
    return skew_join(asked, known, "range", fan_out=True, **skew).select("request", "topic").distinct()


def first_users(user_topics: DataFrame, shown: int = SHOWN) -> DataFrame:
    """The first ``shown`` users of each topic in each range: ``topic, level, block, usr, first_day``.

    Those of a window are found among those of its ranges: whoever is not among the first of its range
    has ``shown`` users of that range before. Spark keeps only so many rows of a topic on the map side too.
    """
    within = in_ranges(user_topics.where("usr IS NOT NULL AND topic IS NOT NULL"))
    firsts = within.groupBy("topic", "level", "block", "usr").agg(F.min("day").alias("first_day"))
    return _first(firsts, ["topic", "level", "block"], shown)


def _first(rows: DataFrame, keys: list[str], shown: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("first_day", "usr")
    ranked = rows.withColumn("place", F.row_number().over(order))
    return ranked.where(F.col("place") <= shown).drop("place")


def topic_users_requests(
    firsts: DataFrame, requests: DataFrame, shown: int = SHOWN, **skew
) -> DataFrame:
    """``topic_users`` for many requests ``request, topic, start, end``: ``request, usr, first_day``.

    ``firsts`` is what ``first_users`` gives for at least as many users. A request reads at most ``shown``
    rows for each of its ranges, however many users the topic has.
    """

    def key() -> Column:
        return F.struct("topic", "level", "block").alias("range")

    asked = asked_ranges(requests).where("request IS NOT NULL AND topic IS NOT NULL")
    asked = asked.select("request", key())
    found = skew_join(asked, firsts.select(key(), "usr", "first_day"), "range", **skew)
    merged = found.groupBy("request", "usr").agg(F.min("first_day").alias("first_day"))
    return _first(merged, ["request"], shown)
