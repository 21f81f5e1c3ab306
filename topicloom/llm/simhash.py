"""SimHash near-duplicates: bit counts of segments, a grid over them, and an exact check.

A fingerprint has 64 bits; a bit is set if it is set in more than half of the hashes of the text's shingles. Two
texts are near when at most ``distance`` bits of their fingerprints differ. A fingerprint is mapped to a point:
the number of set bits in each of 32 segments of two bits. The Manhattan distance of two points is at
most the number of bits that differ, so near fingerprints have near points.

The join of near points goes over a grid. The segments are dealt into more groups than ``distance``; of two near
points, all but ``distance`` groups at least have no distance at all. So a cell is a choice of that many
groups together with the points' counts in them, and each point is in one cell of every choice. How
many groups there are follows from the number of different fingerprints, so that cells stay small however many
there are. In a cell pairs are first held against the Manhattan distance and those that pass
against the bits. A cell returns no pairs but, for each fingerprint, one that it is joined with there.

A cell with many members, such as a group of very many near copies, is dealt into parts. What is joined within
the parts is one component nearly always; then only members outside of the largest component of their cell
are compared with the other parts. So no task holds more than about twice ``MEMBERS`` of a cell, no link is
lost, and a dense group costs in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from topicloom.llm.components import components
from topicloom.llm.words import _LOWER, Words, slices, text_buffer, words
from topicloom.operators.skew import skew_join
from topicloom.session import saved

SEED = 42
ODD = 0x5555555555555555  # the lower bit of each segment
MEMBERS = 4096  # of a cell in one part
SMALL = 64  # members of cells that are compared together
SALTS = 32  # of a cell while its members are told how many there are
CELL = 64  # different fingerprints that a cell should have at most, if they were drawn evenly
BITS = 1 << 16  # hashes whose bits are counted at once


def shingle_hashes(texts: pa.Array, found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each ``size`` neighbouring words, lower-case and joined by a space, and their rows.

    A text with fewer words is hashed whole.
    """
    data, _ = text_buffer(texts)
    data = _LOWER[data]
    inner = np.append(False, found.doc[1:] == found.doc[:-1])[: len(found.doc)]
    data[found.start[inner] - 1] = 0x20
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, np.where(inner, found.start - 1, found.start), 1)
    np.add.at(inside, found.end, -1)
    mask = np.cumsum(inside[:-1], dtype=np.int8) > 0
    at = np.append(0, np.cumsum(mask, dtype=np.int64))
    joined = data[mask].tobytes()
    start, end = at[found.start], at[found.end]
    count = np.diff(found.first())
    last = found.first()[1:][found.doc]  # behind the last word of the text
    number = np.arange(len(found.doc))
    short = count[found.doc] < size
    begins = np.flatnonzero((number + size <= last) | (short & ~inner))
    ends = np.where(short[begins], last[begins], begins + size) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [
        digest(joined[a:b], SEED)
        for a, b in zip(start[begins].tolist(), end[ends].tolist(), strict=True)
    ]
    return np.array(hashes, dtype=np.uint64), found.doc[begins]


def majority_bits(hashes: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """For each row the bits that are set in more than half of its hashes; 0 without hashes."""
    counts = np.zeros((docs, 64), np.int64)
    for a in range(0, len(hashes), BITS):
        part, rows = hashes[a : a + BITS], doc[a : a + BITS]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cuts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        counts[rows[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    total = np.bincount(doc, minlength=docs)
    set_bits = np.packbits(2 * counts > total[:, None], axis=1, bitorder="little")
    return set_bits.view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``_id`` and ``fp``, the fingerprint as a signed number, for each row."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                found = words(texts)
                made = majority_bits(*shingle_hashes(texts, found, size), found.docs)
                columns = [part.column("_id"), pa.array(made.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "fp"])

    named = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    schema = StructType([named.schema["_id"], *StructType.fromDDL("fp bigint").fields])
    return named.mapInArrow(emit, schema)


def counts_of(fp: Column) -> Column:
    """The bit counts 0, 1, 2 of the 32 segments, written as 00, 01, 11."""
    low, high = fp.bitwiseAND(ODD), F.shiftrightunsigned(fp, 1).bitwiseAND(ODD)
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def groups_for(fingerprints: int, distance: int) -> int:
    """Number of groups of segments, so that cells have about ``CELL`` members at most.

    A segment's count has 1.5 bits of information. From 31 groups on nothing would be gained.
    """
    groups = distance + 2
    while groups < 31 and fingerprints > CELL * 2 ** (48 * (groups - distance) / groups):
        groups += 2
    return min(groups, 31)


def cell_masks(groups: int, distance: int) -> list[int]:
    """For each choice of groups without distance, the bits of their segments, as signed numbers."""
    cuts = [32 * k // groups for k in range(groups + 1)]
    bits = [(1 << 2 * b) - (1 << 2 * a) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(bits, groups - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _counts(x: np.ndarray) -> np.ndarray:
    """As ``counts_of``: the bits in which two of them differ are the Manhattan distance."""
    low, high = x & np.uint64(ODD), (x >> np.uint64(1)) & np.uint64(ODD)
    return (low | high) | ((low & high) << np.uint64(1))


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Where the bits of a and b differ in ``distance`` places at most, the lower bound first."""
    ok = np.bitwise_count(_counts(a) ^ _counts(b)) <= distance
    at = np.nonzero(ok)
    ok[at] = np.bitwise_count((a ^ b)[at]) <= distance
    return ok


def cell_links(x: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join what is near in one cell: from a member that is not yet joined to its neighbours."""
    out, rest = [], np.unique(x)
    while len(rest) > 1:
        frontier, root, rest = rest[:1], rest[:1], rest[1:]
        while len(frontier) and len(rest):
            some, frontier = frontier[:SMALL], frontier[SMALL:]
            found = _near(some[:, None], rest[None, :], distance).any(axis=0)
            new, rest = rest[found], rest[~found]
            out.append((new, np.broadcast_to(root, new.shape)))
            frontier = np.concatenate([frontier, new])
    return out


def grouped_links(group: np.ndarray, x: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """The links of all groups of an array sorted by group: two arrays."""
    left, right = [x[:0]], [x[:0]]
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(cuts, len(group)))
    for at, size in zip(cuts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        for a, b in cell_links(x[at : at + size], distance):
            left.append(a)
            right.append(b)
    few = np.repeat(sizes <= SMALL, sizes)
    group, x = group[few], x[few]
    near = [(np.zeros(0, np.int64),) * 2]
    for step in range(1, min(SMALL, len(x))):
        a = np.flatnonzero(group[:-step] == group[step:])
        if not len(a):
            break
        a = a[_near(x[a], x[a + step], distance)]
        near.append((a, a + step))
    a, b = (np.concatenate(side) for side in zip(*near, strict=True))
    label = np.arange(len(x))
    while True:  # the first member of each component
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    joined = np.flatnonzero(label != np.arange(len(x)))
    left.append(x[joined])
    right.append(x[label[joined]])
    return np.concatenate(left), np.concatenate(right)


LINK = "a bigint, b bigint"


def links_within(rows: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Links between near fingerprints ``fp`` of the same ``keys``, which is a bounded number of rows."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def found(table: pa.Table) -> pa.RecordBatch:
            columns = [table.column(k).to_numpy() for k in keys]
            new = np.zeros(table.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            x = table.column("fp").to_numpy().view(np.uint64)
            a, b = grouped_links(np.cumsum(new), x, distance)
            pairs = [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]
            return pa.RecordBatch.from_arrays(pairs, ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            same = np.ones(table.num_rows, bool)
            for k in keys:
                column = table.column(k).to_numpy()
                same &= column == column[-1]
            cut = int(np.argmax(same))  # the last group may go on in the next batch
            if cut:
                yield found(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None:
            yield found(rest)

    dealt = rows.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(emit, LINK).where("a != b")


def near_links(prints: DataFrame, distance: int, members: int = MEMBERS) -> DataFrame:
    """Links ``a``, ``b`` whose components are those of all pairs of near fingerprints.

    ``prints`` has each fingerprint ``fp`` once. Its number is all that reaches the driver.
    """
    masks = cell_masks(groups_for(prints.count(), distance), distance)
    choice = F.posexplode(F.array(*(F.lit(m) for m in masks))).alias("choice", "mask")
    cell = F.xxhash64("choice", F.col("mask").bitwiseAND(F.col("counts"))).alias("cell")
    points = prints.select("fp", counts_of(F.col("fp")).alias("counts"))
    cells = points.select("fp", "counts", choice).select("fp", cell)
    # Cells that meet by their hash are one cell; that adds comparisons, no links.
    large = (
        cells.groupBy("cell").agg(F.count("*").alias("count")).where(F.col("count") > members)
    )
    parts = F.ceil(F.col("count") / members).cast("int")
    large = saved(large.select("cell", parts.alias("parts")), "large_cells")
    salted = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(SALTS)).cast("int")
    parts = F.coalesce("parts", F.lit(1))
    placed = (
        cells.withColumn("salt", salt)
        .join(salted, ["cell", "salt"], "left")
        .withColumn("part", F.pmod(F.xxhash64("fp", "cell"), parts).cast("int"))
        .select("cell", "part", "parts", "fp")
    )
    first = saved(links_within(placed, ["cell", "part"], distance), "cell_links")
    if large.isEmpty():
        return first
    # What is still apart in a large cell: members outside its largest component meet all parts.
    labels = components(first)
    own = placed.where("parts IS NOT NULL").join(
        labels.withColumnRenamed("vertex", "fp"), "fp", "left"
    )
    own = saved(own.withColumn("label", F.coalesce("label", "fp")), "large_members")
    sizes = own.groupBy("cell", "label").agg(F.count("*").alias("n"), F.max("parts").alias("parts"))
    per_cell = sizes.groupBy("cell").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"),
        F.max("parts").alias("parts"),
        F.ceil((F.sum("n") - F.max("n")) / members).cast("int").alias("turns"),
    )
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    open_cells = per_cell.where("turns > 0").select("cell", "main", "turns", every, "parts")
    rows = own.drop("parts").join(saved(open_cells, "open_cells"), ["cell", "part"])
    rows = saved(rows, "open_members")
    turns = F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn")
    turn = F.pmod(F.xxhash64("fp", "cell", F.lit(2)), F.col("turns")).cast("int").alias("turn")
    stay = rows.select("cell", "part", turns, "fp")
    visit = rows.where("label != main").select("cell", every, turn, "fp")
    second = links_within(stay.unionByName(visit), ["cell", "part", "turn"], distance)
    return first.unionByName(saved(second, "part_links"))


def near_components(
    docs: DataFrame,
    size: int = 5,
    distance: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    members: int = MEMBERS,
) -> DataFrame:
    """One row per row of ``docs``: the id, its ``fingerprint`` (16 hex digits) and ``component_id``.

    Texts are lower-cased (A-Z); the shingles are ``size`` neighbouring words, as often as they occur, and their
    hashes XXH64 with seed 42 of the words joined by a space. A text with fewer words is one shingle; a
    text that is null, empty or without words has the fingerprint zero and links like any other. Two
    texts link when ``distance`` bits at most differ; ``component_id`` is the smallest id that links lead to.
    Null ids name no component unless there is no other id in it. Rows that repeat an id count each, and
    equal texts have equal fingerprints. Texts are read whole. No rows give no rows. Other columns are not
    looked at. ``members`` steers only how large cells are dealt.
    """
    prints = saved(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = saved(prints.groupBy("fp").agg(F.min("_id").alias("rep")), "classes")
    labels = components(near_links(classes.select("fp"), distance, members))
    named = classes.join(labels.withColumnRenamed("vertex", "fp"), "fp", "left")
    named = saved(named.withColumn("label", F.coalesce("label", "fp")), "labelled")
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_print = saved(skew_join(named, least, "label").select("fp", "component_id"), "of_print")
    found = skew_join(prints, of_print, "fp")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select(F.col("_id").alias(id_col), digits, "component_id")
