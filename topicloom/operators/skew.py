"""Keys that hold much of the data, and joins that survive them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a key that one task takes without trouble.
HOT_FLOOR = 100_000


def each_row(count: Column) -> Column:
    """The weight 1 for every row of a counted table.

    It is written in terms of the count so that the column stays in the plan: finding the hot
    keys then needs the same shuffle as the main branch, and Spark runs it once.
    """
    return F.least(count, F.lit(1))


def hot_keys(
    df: DataFrame, keys: Sequence[str], weight: Column | None = None, floor: int = HOT_FLOOR
) -> DataFrame:
    """Hot keys and the number of salts to spread each over: one for every ``floor`` rows.

    The count combines on the map side, so a hot key costs no task more than another. Which
    keys are hot steers only where rows go; every row of every key stays. There are at most as many
    hot keys as rows over ``floor``; neither they nor their salts are limited.
    """
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    pieces = F.ceil(F.col("size") / F.lit(floor)).cast("bigint")
    return (
        df.groupBy(*keys)
        .agg(size.alias("size"))
        .where(F.col("size") > floor)
        .select(*keys, pieces.alias("salts"))
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    weight: Column | None = None,
    floor: int = HOT_FLOOR,
    fan_out: bool | int = False,
) -> DataFrame:
    """Inner equi-join that spreads the hot keys of the left side over many tasks.

    The right side has few rows per key, such as the topics of a repository.
    Rows of a hot key are salted by a hash of the whole row, and the right rows of that key are
    repeated once per salt. Each left row meets each of its right rows exactly once. ``weight``
    is what a left row weighs, one by default. ``fan_out`` says that a left row
    meets many right rows: all shuffle partitions are then kept, where Spark would merge those
    that are small before the join; a number is how many there are at least.
    """
    left = left.where(F.col(key).isNotNull())
    hot = hot_keys(left, [key], weight, floor)
    salts = F.coalesce(F.col("salts"), F.lit(1))
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    spread = left.join(hot, key, "left").withColumn("salt", F.pmod(row_hash, salts)).drop("salts")
    if fan_out:
        partitions = max(fan_out, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        spread = spread.repartition(partitions, key, "salt")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))
    repeated = right.join(hot, key, "left").withColumn("salt", copies).drop("salts")
    return spread.join(repeated, [key, "salt"]).drop("salt")
