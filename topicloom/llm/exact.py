"""Exact duplicates: equal 128-bit content hashes, then equal bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.session import saved


def content_hash(text: str) -> Column:
    """128-bit hash of a text column; null is empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stays: str = "smallest"
) -> DataFrame:
    """One row per row of ``docs`` with the group of texts identical to its own.

    Columns: the id, ``keep_id`` (the ``smallest`` or ``largest`` id of the group), ``group_size``
    (rows), ``kept``, ``text_sha256``. Rows are grouped by a 128-bit hash and, within it, by the bytes
    of the text, so a collision separates. Equal texts meet on the map side first, and the rows
    looked up afterwards are short, so a group of any size is spread over many tasks.

    A null text is empty. Null ids are passed over unless a group has no other; then ``keep_id`` is
    null. Of rows alike in id and text one is kept. An empty table gives no rows. Other columns are
    not looked at.
    """
    if stays not in ("smallest", "largest"):
        raise ValueError(f"stays must be smallest or largest, not {stays!r}")
    best = F.min if stays == "smallest" else F.max
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        content_hash(text_col).alias("_hash"),
    )
    groups = (
        rows.groupBy("_hash", "_text")
        .agg(best("_id").alias("_keep"), F.count("*").alias("_size"))
        .where(F.col("_size") > 1)
        .select("_hash", F.sha2("_text", 256).alias("_sha"), "_keep", "_size")
    )
    # Written, so that the join below has a plain shuffle on both sides and a large group is split.
    groups = saved(groups, "exact_groups")
    alike = (
        rows.select("_id", "_hash", F.sha2("_text", 256).alias("_sha"))
        .groupBy("_id", "_hash", "_sha")
        .agg(F.count("*").alias("_rows"))
    )
    found = saved(alike, "exact_rows").join(groups, ["_hash", "_sha"], "left")
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return found.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))).alias("_copy")
    ).select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("_id").eqNullSafe(keep) & (F.col("_copy") == 1)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of identical texts: that with the smallest id.

    All columns are returned as they came. Null texts are one group with empty ones. A null id stays
    only if its group has no other; of several rows with the kept id and text, one of them stays. Texts
    are shuffled once, and copies that a task has already seen are not shuffled at all.
    """
    names = docs.columns
    own = F.col(f"`{id_col}`")
    rest = F.struct(
        F.col(f"`{text_col}`").isNull().alias("_null"),
        *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names) if c != text_col),
    )
    rows = docs.select(
        content_hash(text_col).alias("_hash"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"),
        F.struct(own.isNull(), own).alias("_order"),
        rest.alias("_rest"),
    )
    one = rows.groupBy("_hash", "_text").agg(F.min_by("_rest", "_order").alias("_rest"))
    text = F.when(~F.col("_rest._null"), F.col("_text"))
    return one.select(
        *(
            (text if c == text_col else F.col(f"_rest.c{k}")).alias(c)
            for k, c in enumerate(names)
        )
    )
