"""Positions in a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.session import saved


def ranged(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows dealt into ranges of an order, with the range's number as ``_range``.

    The ranges are drawn from a sample, so they are written down before anything reads them twice.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order)
    return saved(dealt.withColumn("_range", F.spark_partition_id()), name)


def numbered(df: DataFrame, order: list[Column], number: str, name: str) -> DataFrame:
    """The rows with their position, from 0, in an order in which no two rows are equal."""
    dealt = ranged(df, order, name)
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row per range: as many as there are shuffle partitions, whatever the data.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        dealt.withColumn("_place", place)
        .join(offsets, "_range")
        .withColumn(number, F.col("_before") + F.col("_place") - 1)
        .drop("_range", "_place", "_before")
    )
