"""Document fingerprints: sums of wide vectors hashed from paragraphs, modulo powers of two.

A fingerprint is an array of 64-bit numbers:

* 1: paragraphs, lowest 32 bits, and sentences, highest 32 bits;
* 2-5: eight sums modulo 2**32 of the paragraphs' hashes, two in each number;
* 6-69: 128 sums modulo 2**32 of numbers drawn by the sentences' hashes from a Cauchy distribution, two in
  each.

Every part is a sum over the paragraphs, so their order does not matter, and paragraphs are put in or
taken out by adding or subtracting the fingerprint of what is put in or taken out. Equal multisets of
paragraphs have equal fingerprints; others differ but for a chance of about 2**-256. A sum of Cauchy numbers,
each as often as its sentence occurs, is Cauchy with the sum of these counts for its scale. So the
differences of two texts' sums are spread like the number of sentences that one text has more of than the other,
repeats included, and their median size is that number, which gives the likeness.

A paragraph is a line that is not empty. A sentence ends behind ``.``, ``!`` or ``?`` and blanks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.ordering import ranged
from topicloom.session import saved

SENTENCE = r"(?<=[.!?]) +"
WIDE = 4  # 64-bit hashes of a paragraph
LANES = 128  # sums of a text's sentences
LOW = (1 << 32) - 1


def _units(text: Column) -> Column:
    """A text's sentences, with the paragraph beside its first one."""
    lines = F.filter(F.split(text, "\n"), lambda line: line != "")
    of_line = F.transform(
        lines,
        lambda line: F.transform(
            F.split(line, SENTENCE),
            lambda s, k: F.struct(s.alias("sentence"), F.when(k == 0, line).alias("paragraph")),
        ),
    )
    return F.flatten(of_line)


def fingerprints(texts: DataFrame, keys: list[str], text_col: str, name: str) -> DataFrame:
    """``texts`` grouped by ``keys``, with the fingerprint of each group's text or texts.

    Texts of one group are added up. A null or empty text has all zeros.
    """
    units = texts.select(*keys, F.explode_outer(_units(F.col(text_col))).alias("_u")).select(
        *keys, "_u.sentence", "_u.paragraph"
    )
    sentence, paragraph = F.col("sentence"), F.col("paragraph")

    def hashed(of: Column, k: int) -> Column:
        return F.when(of.isNotNull(), F.xxhash64(of, F.lit(k)))

    sums = [F.count("paragraph").alias("_p"), F.count("sentence").alias("_s")]
    for k in range(WIDE):
        h = F.col(f"_w{k}")
        sums += [
            F.sum(h.bitwiseAND(F.lit(LOW))).alias(f"_w{k}l"),
            F.sum(F.shiftrightunsigned(h, 32)).alias(f"_w{k}h"),
        ]
    for k in range(LANES):
        part = F.shiftrightunsigned(F.col(f"_b{k // 4}"), 16 * (k % 4)).bitwiseAND(F.lit(0xFFFF))
        # tan of an even angle is Cauchy; 16 bits of it, so no number is beyond 2**15.
        drawn = F.tan((part + F.lit(0.5)) * F.lit(math.pi / 65536) - F.lit(math.pi / 2))
        sums.append(F.sum(F.rint(drawn).cast("bigint")).alias(f"_c{k}"))
    summed = (
        units.select(
            *keys,
            *(hashed(paragraph, k).alias(f"_w{k}") for k in range(WIDE)),
            hashed(sentence, WIDE).alias("_h"),
            "paragraph",
            "sentence",
        )
        .select(
            *keys, *(f"_w{k}" for k in range(WIDE)), "paragraph", "sentence",
            *(F.when(F.col("_h").isNotNull(), F.xxhash64("_h", F.lit(k))).alias(f"_b{k}")
              for k in range(LANES // 4)),
        )
        .groupBy(*keys)
        .agg(*sums)
    )

    def pair(low: str, high: str) -> Column:
        """Two sums modulo 2**32 in one number."""
        one, other = (F.coalesce(F.col(c), F.lit(0)).bitwiseAND(F.lit(LOW)) for c in (low, high))
        return one.bitwiseOR(F.shiftleft(other, 32))

    parts = [pair("_p", "_s")]
    parts += [pair(f"_w{k}l", f"_w{k}h") for k in range(WIDE)]
    parts += [pair(f"_c{k}", f"_c{k + 1}") for k in range(0, LANES, 2)]
    return summed.select(*keys, F.array(*parts).alias(name))


def _by_lanes(a: Column, b: Column, sign: int) -> Column:
    def one(x: Column, y: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for shift in (0, 32):
            p, q = (F.shiftrightunsigned(z, shift).bitwiseAND(F.lit(LOW)) for z in (x, y))
            out = out.bitwiseOR(F.shiftleft((p + sign * q).bitwiseAND(F.lit(LOW)), shift))
        return out

    return F.zip_with(a, b, one)


def plus(a: Column, b: Column) -> Column:
    """Fingerprint of all paragraphs of two."""
    return _by_lanes(a, b, 1)


def minus(a: Column, b: Column) -> Column:
    """Fingerprint of the first's paragraphs without the second's."""
    return _by_lanes(a, b, -1)


def shown(fingerprint: Column) -> Column:
    """The fingerprint as lowercase hex digits."""
    digits = F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.lower(F.array_join(digits, ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common sentences among all of two texts, 0 to 1; 1 if equal.

    A sentence counts as often as it occurs. The number of differing sentences is the median of 128
    differences, whose standard error is an eighth to a seventh of it; it is at least the difference of the
    texts' numbers of sentences, at most their sum, and odd or even as that sum. It holds up to some
    hundred million differing sentences.
    """
    n = F.shiftrightunsigned(F.element_at(a, 1), 32)
    m = F.shiftrightunsigned(F.element_at(b, 1), 32)

    def sizes(x: Column, y: Column) -> Column:
        found = []
        for shift in (0, 32):
            p, q = (F.shiftrightunsigned(z, shift).bitwiseAND(F.lit(LOW)) for z in (x, y))
            half = F.lit(1 << 31)
            found.append(F.abs(F.pmod(p - q + half, F.lit(1 << 32)) - half))
        return F.array(*found)

    first, count = 2 + WIDE, LANES // 2
    each = F.array_sort(F.flatten(F.zip_with(F.slice(a, first, count), F.slice(b, first, count), sizes)))
    median = (F.element_at(each, LANES // 2) + F.element_at(each, LANES // 2 + 1)) / F.lit(2.0)
    total = n + m
    differ = total - 2 * F.rint((total - F.greatest(F.abs(n - m), F.least(total, median))) / 2)
    return F.when(a == b, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(
        (total - differ) / (total + differ)
    )


def with_next(rows: DataFrame, row: str, order: list[str]) -> DataFrame:
    """Each ``row`` with the ``next_row`` in descending order; the last one's is the first.

    ``order`` ends with ``row`` itself, so no two are equal.
    """
    dealt = ranged(rows, [F.col(c).desc() for c in order], "fingerprint_ranges")
    falling = [F.col(c).desc() for c in order]
    ahead = Window.partitionBy("_range").orderBy(*falling)
    # One row per range: as many as shuffle partitions, whatever the data.
    firsts = dealt.groupBy("_range").agg(F.max(F.struct(*order)).alias("_first"))
    ranges = Window.orderBy("_range")
    whole = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select(
        "_range",
        F.coalesce(F.lead(f"_first.{row}").over(ranges), F.first(f"_first.{row}").over(whole)).alias(
            "_after"
        ),
    )
    return (
        dealt.withColumn("_lead", F.lead(row).over(ahead))
        .join(after, "_range")
        .withColumn("next_row", F.coalesce("_lead", "_after"))
        .drop("_range", "_lead", "_after")
    )


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of all texts and of their edited texts.

    An edited text has the last half of its code points replaced by as many (or all) from the
    beginning of the next document by descending id; the last document is followed by the first.
    Columns: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (hex digits),
    ``near_edited``, ``near_next`` (likeness of the fingerprint to those two).

    A null text is empty; null ids come last; rows with one id are ordered by a hash of id and text.
    Rows alike in both count as one document and each gets its result. A document alone is its own
    next one. An empty table gives no rows. Each text is shuffled once, and the piece that another
    document takes of it once more; its fingerprint is shuffled twice.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.unhex(F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.md5(text))))
    given = docs.select(key.alias("row"), F.col(id_col).alias("_id"), text.alias("_text"))
    ids = given.groupBy("row").agg(
        F.first("_id").alias("_id"),
        F.max(F.length("_text")).alias("n"),
        F.count("*").alias("rows"),
    )
    order = with_next(ids, "row", ["_id", "row"])
    order = saved(order.withColumn("half", F.floor(F.col("n") / 2).cast("int")), "fingerprint_order")
    texts = given.select("row", "_text").groupBy("row").agg(F.first("_text").alias("_text"))
    wanted = order.where("half > 0").select(F.col("row").alias("by"), "next_row", "half")
    pieces = texts.join(wanted, F.col("row") == F.col("next_row")).select(
        F.col("by").alias("row"), F.left("_text", F.col("half")).alias("_piece")
    )
    both = texts.join(order, "row").join(pieces, "row", "left")
    kept = F.left("_text", (F.col("n") - F.col("half")).cast("int"))
    both = both.withColumn("_edited", F.concat(kept, F.coalesce("_piece", F.lit(""))))
    edited = both.select("row", "_edited", F.sha2("_edited", 256).alias("sha"))
    made = fingerprints(edited, ["row", "sha"], "_edited", "fp_edited")
    # Texts and edited texts lie by row. Each text's fingerprint is made once and sent to its own row and to the
    # one it is next to, in one exchange; the edited text's stays where it is made, and none is written down.
    own = fingerprints(texts, ["row"], "_text", "fp")
    follows = order.select(F.col("row").alias("by"), "next_row")
    ways = F.array(
        F.struct(F.col("row").alias("to"), F.lit(False).alias("next")),
        F.struct(F.col("by").alias("to"), F.lit(True).alias("next")),
    )
    sent = own.join(follows, F.col("row") == F.col("next_row")).select("fp", F.explode(ways).alias("_way"))
    held = sent.groupBy(F.col("_way.to").alias("row")).agg(
        F.max(F.when(~F.col("_way.next"), F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("_way.next"), F.col("fp"))).alias("fp_next"),
    )
    return (
        made.join(held, "row")
        .join(order.select("row", "_id", "n", "rows"), "row")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
        .select(
            F.col("_id").alias(id_col),
            F.col("n").cast("bigint").alias("n_chars"),
            F.col("sha").alias("edited_sha256"),
            shown(F.col("fp")).alias("fingerprint"),
            shown(F.col("fp_edited")).alias("edited_fingerprint"),
            likeness(F.col("fp"), F.col("fp_edited")).alias("near_edited"),
            likeness(F.col("fp"), F.col("fp_next")).alias("near_next"),
        )
    )
