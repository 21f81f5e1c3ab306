"""Quotation linking: conversations in reply order, without quotes.

A line is quoted as many levels deep as there are ``>`` before its text. Lines of one level between
blank lines or lines of another level are a passage. Passages and single lines are compared in lower
case with white space collapsed, by a 128-bit hash within the conversation. The original of a quoted
passage is the earliest message that has it unquoted; a message answers the one it quotes most of at
the lowest level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from topicloom.llm.ordering import numbered
from topicloom.session import saved

MARK = r"^[ \t]*(?:>[ \t]*)+"
SAYS = r"(?m)^On [^\n]{1,200} wrote:[ \t]*\n(?=[ \t]*>)"  # the line that mail programs put above a quote


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, SAYS, ""), "\r?\n")


def unquoted(text: Column) -> Column:
    """The text without quoted lines and the lines that announce them; blank ends are cut."""
    own = F.filter(_lines(text), lambda line: ~line.rlike(MARK))
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """``row``, ``level``, ``key`` and ``size`` of the passages and lines of messages.

    ``messages`` has ``row``, ``conv`` (text) and ``text``. A message's lines meet in one task, as its
    text has been in one before.
    """
    lines = messages.select("row", "conv", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    mark = F.regexp_extract("line", MARK, 0)
    parsed = lines.select(
        "row",
        "conv",
        "pos",
        F.length(F.regexp_replace(mark, "[^>]", "")).alias("level"),
        _normal(F.regexp_replace("line", MARK, "")).alias("body"),
    )
    order = Window.partitionBy("row", "conv").orderBy("pos")
    new = (F.col("level") != F.lag("level", 1, -1).over(order)) | (F.lag("body", 1, "").over(order) == "")
    runs = (
        parsed.withColumn("new", new.cast("int"))
        .withColumn("run", F.sum("new").over(order))
        .where("body != ''")
    )
    whole = runs.groupBy("row", "conv", "run", "level").agg(
        F.sort_array(F.collect_list(F.struct("pos", "body"))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda p: p["body"]), " ")
    kinds = whole.select(
        "row",
        "conv",
        "level",
        F.explode(F.array_distinct(F.concat(F.array(joined), F.transform("parts", lambda p: p["body"])))).alias(
            "body"
        ),
    )
    return kinds.select(
        "row",
        "level",
        F.unhex(F.md5(F.concat_ws("\n", "conv", "body"))).alias("key"),
        F.length("body").alias("size"),
    )


def _roots(links: DataFrame) -> DataFrame:
    """``row``, its ``root`` and ``depth`` of messages that answer another, by pointer doubling."""
    known = saved(links.select("row", F.col("parent").alias("root"), F.lit(1).alias("depth")), "roots")
    while True:
        up = known.select(
            F.col("row").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more")
        )
        if known.join(up, "root", "left_semi").isEmpty():
            return known
        known = known.join(up, "root", "left").select(
            "row",
            F.coalesce("higher", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        )
        known = saved(known, "roots")


def linked_conversations(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per message, its text without quotes, and its place in the reply order.

    Columns: conversation, turn, role, text (unquoted), ``quoted`` (passages and lines it quotes),
    ``linked`` (those with an original in an earlier turn of the conversation), ``reply_to`` (turn of the
    message it answers, null if none), ``thread`` (turn of the message that the answers go back to),
    ``depth`` and ``position`` (from 0 in the conversation: by thread, then turn, so an answer follows
    what it answers and stays with its thread).

    A null text is empty. A null conversation is one; a null turn comes first and neither answers nor is
    answered. Rows alike in everything come several times. Messages of one conversation and turn are
    told apart by role and text, and do not answer each other. An empty table gives no rows.

    Originals are found by a minimum with map-side combine, so a common line is one row in the join;
    a conversation of any size is spread by its passages' hashes.
    """
    conv = F.coalesce(F.col(conv_col).cast("string"), F.lit("\0"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    turn = F.col(turn_col)
    key = F.concat_ws(
        "\n", conv, F.coalesce(turn.cast("string"), F.lit("\0")),
        F.coalesce(F.col(role_col), F.lit("\0")), F.md5(text),
    )
    given = messages.select(
        F.unhex(F.md5(key)).alias("row"), conv.alias("conv"), F.col(conv_col).alias("_conv"),
        turn.alias("_turn"), F.col(role_col).alias("_role"), text.alias("text"),
    )
    once = given.groupBy("row").agg(
        *(F.first(c).alias(c) for c in ("conv", "_conv", "_turn", "_role", "text")),
        F.count("*").alias("_rows"),
    )
    once = saved(once, "messages")
    found = passages(once).join(once.select("row", "_turn"), "row").where("_turn IS NOT NULL")
    found = saved(found, "passages")
    originals = found.where("level = 0").groupBy("key").agg(F.min("_turn").alias("_first"))
    earliest = found.where("level = 0").join(originals, "key").where(F.col("_turn") == F.col("_first"))
    # Of several messages of that turn, one.
    originals = earliest.groupBy("key", "_first").agg(F.min("row").alias("original"))
    quotes = found.where("level > 0").join(saved(originals, "originals"), "key", "left")
    early = F.col("_first") < F.col("_turn")
    quotes = saved(
        quotes.withColumn("original", F.when(early, F.col("original"))), "quotes"
    )
    counts = quotes.groupBy("row").agg(
        F.count("*").alias("quoted"), F.count("original").alias("linked")
    )
    parents = (
        quotes.where("original IS NOT NULL")
        .groupBy("row", "level", "original", "_first")
        .agg(F.sum("size").alias("size"))
        .groupBy("row")
        .agg(F.max(F.struct(-F.col("level"), "size", "_first", "original")).alias("best"))
        .select("row", F.col("best.original").alias("parent"), F.col("best._first").alias("reply_to"))
    )
    parents = saved(parents, "parents")
    roots = _roots(parents)
    turns = once.select(F.col("row").alias("root"), F.col("_turn").alias("_root_turn"))
    placed = (
        once.join(counts, "row", "left")
        .join(parents.drop("parent"), "row", "left")
        .join(roots.join(turns, "root").select("row", "_root_turn", "depth"), "row", "left")
        .withColumn("thread", F.coalesce("_root_turn", "_turn"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
    )
    order = [F.col(c).asc() for c in ("conv", "thread", "_turn", "row", "_copy")]
    placed = saved(numbered(placed, order, "_number", "reply_order"), "placed")
    starts = placed.groupBy("conv").agg(F.min("_number").alias("_start"))
    return placed.join(starts, "conv").select(
        F.col("_conv").alias(conv_col),
        F.col("_turn").alias(turn_col),
        F.col("_role").alias(role_col),
        unquoted(F.col("text")).alias(text_col),
        F.coalesce("quoted", F.lit(0)).cast("bigint").alias("quoted"),
        F.coalesce("linked", F.lit(0)).cast("bigint").alias("linked"),
        "reply_to",
        "thread",
        F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"),
        (F.col("_number") - F.col("_start")).cast("bigint").alias("position"),
    )
