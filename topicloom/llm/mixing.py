"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.ordering import numbered
from topicloom.session import saved

WORD = r"[^\x20\x09-\x0D]+"
GROUP = 10_000  # rows that one window looks at; only the work is divided by it, not the result


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], most: int, budget: float = 1.0
) -> DataFrame:
    """Target words of each source.

    ``sizes`` has a row per ``_source`` with ``_total`` words. Weights are dealt out in turn in code
    point order, null last. A target stops at ``most`` times its source's words, and what is over
    goes to the others by weight, again until none is above. Only sums reach the driver.
    """
    order = [F.col("_source").asc_nulls_last()]
    ranked = numbered(sizes, order, "_rank", "mix_sources")
    turn = (F.col("_rank") % len(weights)).cast("int") + 1
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), turn)
    ranked = saved(ranked.withColumn("_weight", weight), "mix_weights")
    cap = F.col("_total") * most
    level, total = 0.0, ranked.agg(F.sum("_total")).first()[0] or 0
    while True:
        above = F.col("_weight") * F.lit(level) > cap
        row = ranked.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0)).alias("open"),
        ).first()
        new = (total * budget - row.capped) / row.open if row.open else level
        if new <= level:
            break
        level = new
    target = F.least(cap.cast("double"), F.col("_weight") * F.lit(level))
    return ranked.select("_source", "_total", target.alias("_target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    budget: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How often the mix takes each row of ``docs``.

    Each source's documents are shuffled by a hash of id and text and queue up, again for each of at
    most ``most`` passes. A document's virtual finish time is the words of its source up to its own
    end, divided by the source's target. All are put in order of that time, and the order is cut
    where the budget (that share of all words) is used up.

    Returns the id, ``size`` (words), ``source_size``, ``target``, ``taken`` (words, repeats counted)
    and the keys ``_source`` and ``_text`` (128-bit hash of the text). A source ends within about a
    document of its target. Texts that are null or without words have size 0 and are never taken. A
    null source is a source. Rows alike in id, source and text queue up together and are
    taken equally often. No rows give no
    rows. The same rows give the same mix, however they are partitioned.

    Running sums are taken within slices of a source of about 10,000 rows (by the hash, so that a
    source with a third of all rows is as many slices as it needs) and added up over the slices.
    """
    text_hash = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    place = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), text_hash))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        text_hash.alias("_text"),
        word_count(text_col).alias("_size"),
        # 52 bits, so that the share below is exact
        F.conv(F.substring(place, 1, 13), 16, 10).cast("bigint").alias("_place"),
    )
    rows = saved(rows, "mix_rows")
    sizes = rows.groupBy("_source").agg(
        F.sum("_size").alias("_total"), F.count("*").alias("_docs")
    )
    targets = saved(
        source_targets(sizes.select("_source", "_total"), weights, most, budget).join(
            sizes.select(F.col("_source").alias("_s"), "_docs"),
            F.col("_source").eqNullSafe(F.col("_s")),
        ),
        "mix_targets",
    ).drop("_s")
    slices = F.ceil(F.col("_docs") / GROUP)
    slice_ = F.floor(F.col("_place") / F.lit(float(1 << 52)) * slices).cast("bigint")
    known = targets.withColumnRenamed("_source", "_s")
    placed = rows.join(known, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    placed = saved(placed.withColumn("_slice", slice_), "mix_placed")
    before = (
        Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        placed.groupBy("_source", "_slice")
        .agg(F.sum("_size").alias("_n"))
        .select(
            F.col("_source").alias("_s"),
            F.col("_slice").alias("_k"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        )
    )
    within = (
        Window.partitionBy("_source", "_slice")
        .orderBy("_place", "_id", "_text")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = placed.withColumn("_sum", F.sum("_size").over(within)).join(
        starts, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_k"))
    )
    end = F.col("_start") + F.col("_sum")
    queue = saved(summed.withColumn("_end", end).drop("_s", "_k", "_start", "_sum"), "mix_queue")
    finish, last = _cut(queue, most, budget)
    copies = F.lit(0)
    for k in range(most):
        at = _finish(F.lit(k))
        on_time = (at < finish) | ((at == finish) & (F.col("_place") <= last))
        copies = copies + F.when((F.col("_size") > 0) & (F.col("_target") > 0) & on_time, 1).otherwise(0)
    return queue.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_total").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * copies).cast("bigint").alias("taken"),
        copies.cast("int").alias("copies"),
        "_source",
        "_text",
    )


def _finish(turn: Column) -> Column:
    """Virtual finish time of a row in its first, second, ... pass (0, 1, ...)."""
    return (F.col("_end") + turn * F.col("_total")).cast("double") / F.col("_target")


def _cut(queue: DataFrame, most: int, budget: float) -> tuple[Column, Column]:
    """Finish time and place of the last pass that the budget has room for.

    The order is summed over steps of about 10,000 passes; only the step in which the budget ends is
    put in order row by row. Passes alike in time and place are taken together or not at all.
    """
    words, count = queue.agg(F.sum("_size"), F.count("*")).first()
    room, steps = (words or 0) * budget, max(1, -(-count // GROUP))
    passes = (
        queue.where((F.col("_size") > 0) & (F.col("_target") > 0))
        .withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .select("_size", "_place", _finish(F.col("_pass")).alias("_finish"))
        .withColumn("_step", F.floor(F.least(F.col("_finish"), F.lit(8.0)) * steps))
    )
    upto = Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = (
        passes.groupBy("_step")
        .agg(F.sum("_size").alias("_n"))
        .select("_step", (F.sum("_n").over(upto) - F.col("_n")).alias("_start"), "_n")
        .where(F.col("_start") + F.col("_n") > F.lit(room))
        .orderBy("_step")
        .first()
    )
    if over is None:
        return F.lit(float("inf")), F.lit(0)
    peers = (
        Window.partitionBy("_step")
        .orderBy("_finish", "_place")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = (
        passes.where(F.col("_step") == over._step)
        .withColumn("_sum", F.sum("_size").over(peers) + over._start)
        .where(F.col("_sum") <= F.lit(room))
        .agg(F.max(F.struct("_finish", "_place")).alias("last"))
        .first()
        .last
    )
    if last is None:  # nothing of this step: what finished before it
        return F.lit(over._step / steps), F.lit(-1)
    return F.lit(last._finish), F.lit(last._place)


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **how: object,
) -> DataFrame:
    """``docs`` as the mix takes them: rows left out are gone, rows taken twice come twice.

    All columns are returned as they came. See ``mix`` for the settings and the cases.
    """
    picks = (
        mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how)
        .where("copies > 0")
        .groupBy(F.col(id_col).alias("_id"), "_source", "_text")
        .agg(F.max("copies").alias("_copies"))
    )
    same = (
        F.col("_row._id").eqNullSafe(F.col("_id"))
        & F.col("_row._from").eqNullSafe(F.col("_source"))
        & (F.col("_key") == F.col("_text"))
    )
    names = docs.columns
    rows = docs.select(
        F.struct(
            F.col(f"`{id_col}`").alias("_id"),
            F.col(f"`{source_col}`").alias("_from"),
            *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)),
        ).alias("_row"),
        F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_key"),
    )
    times = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return (
        rows.join(picks, same)
        .select("_row", times.alias("_time"))
        .select(*(F.col(f"_row.c{k}").alias(c) for k, c in enumerate(names)))
    )
