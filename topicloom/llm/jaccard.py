"""N-gram Jaccard join: rare-first prefixes, length, positional and suffix filters, one check a pair.

The sets are the distinct word shingles of whole texts. Documents with equal sets are one class, so
copies never meet each other (a task sends one prefix for all it has). A class is a vertex; two classes link when their sets are similar
enough. What is asked for is each document's connected component, and for that a pair need not be
looked at when other links already join its two sides:

1. every class is compared with one leader of each prefix shingle it shares; these links are joined;
2. pairs that are still apart and share a prefix shingle pass the filters in blocks of at most two
   times ``BLOCK`` members, at the first of the shingles they share as far as the ``BEFORE`` last ones tell. What
   is left goes on as packed lists, one for each two ``BUNDLE`` of classes, in which the highest 16 bits of
   those classes' shingles meet once: two sets share at most as many shingles as they share of these. The
   pairs that may still link are few and are verified by whole shingles. Classes are
   numbered by their rarest shingle, so classes that are alike are in few bundles.

The order of shingles is by how many documents have them, as counted over all documents in a table of
``COUNTERS`` counters (a shingle counts at a fixed place, so the table has the same size whatever the
input), then by hash. Any order gives the same result; rare first makes the groups small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from topicloom.llm.components import components
from topicloom.llm.counters import SCHEMA, counter_rows, summed
from topicloom.llm.words import distinct, shingle_sets, slices
from topicloom.session import saved

COUNTERS = 1 << 20  # 4 MB
BLOCK = 512
WANTED = 1 << 22  # bits of a bitmap of keys
BUCKET = 1 << 15  # of them in one of Spark's bitmaps
BUNDLE = 128  # classes whose sets are sent together, by their numbers
FEW = 32  # pairs of two bundles that are compared one at a time
COLUMNS = 1 << 14  # shingles of two bundles that are multiplied at once
LANES = 128  # of a set's histogram, by the highest bits of its hashes
BEFORE = 3  # shared shingles of a prefix before one, by which pairs are told that have met there
HELD = 1 << 21  # pairs that a task holds to leave out those it has again


def shingle_counters(docs: DataFrame, text_col: str, size: int) -> np.ndarray:
    """How many documents have a shingle at each place of the table, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                places = np.concatenate(sets) & np.uint64(COUNTERS - 1)
                table += np.bincount(places.astype(np.int64), minlength=COUNTERS)
        yield from counter_rows(table)

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, SCHEMA)
    return np.minimum(summed(counted, COUNTERS), (1 << 32) - 1).astype(np.uint32)


def _key(s: np.ndarray) -> int:
    """A set's 64-bit hash, signed."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))))


def _lanes(s: np.ndarray) -> bytes:
    """How many hashes a set has in each lane, 255 for more."""
    counts = np.bincount((s >> np.uint64(57)).astype(np.int64), minlength=LANES)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def shingle_prefixes(
    docs: DataFrame, id_col: str, text_col: str, size: int, percent: int
) -> DataFrame:
    """Each document's ``key`` (64-bit hash of its set), ``n``, rare-first ``prefix`` and ``lanes``.

    Of documents with equal sets only the first of a task has a prefix and lanes.
    """
    spark = docs.sparkSession
    counters = spark.sparkContext.broadcast(shingle_counters(docs, text_col, size))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = counters.value, set()
        for batch in batches:
            for part in slices(batch, "text"):
                keys, sizes, rare, lanes = [], [], [], []
                for s in shingle_sets(part.column("text"), size):
                    n = len(s)
                    keys.append(_key(s))
                    sizes.append(n)
                    keep = n - -(-percent * n // 100) + 1 if n and keys[-1] not in known else 0
                    known.add(keys[-1])
                    df = table[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                    order = np.argsort(df, kind="stable")[:keep]
                    rare.append(s[order].view(np.int64))
                    lanes.append(_lanes(s) if keep else None)
                ends = np.cumsum([0, *map(len, rare)]).astype(np.int32)
                values = pa.array(np.concatenate(rare) if rare else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends), values), pa.array(lanes, pa.binary())],
                    ["_id", "key", "n", "prefix", "lanes"],
                )

    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    schema = StructType(
        [StructField("_id", docs.schema[id_col].dataType)]
        + StructType.fromDDL("key bigint, n int, prefix array<bigint>, lanes binary").fields
    )
    return named.mapInArrow(prefixes, schema)


def wanted_sets(
    docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int, short: bool = False
) -> DataFrame:
    """``key`` and ``shingles`` of the sets in ``wanted`` (``key`` and ``rep``, the id of a document).

    ``short`` asks for the highest 16 bits of each shingle only, which may repeat.
    What is wanted is sent to all tasks as a bitmap of fixed size, so that the texts stay where they
    are. A few other sets only fall on the same bits; they meet no pair in a join.
    """
    place = F.pmod(F.col("key").bitwiseXOR(F.xxhash64("rep")), F.lit(WANTED)) + 1
    bits = (
        wanted.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()  # WANTED bits at most
    )
    table = np.zeros((WANTED // BUCKET, BUCKET // 8), np.uint8)
    for row in bits:
        table[row.bucket - 1] = np.frombuffer(bytes(row.bits), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table.ravel())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                keys, sets = [], []
                ids = part.column("hash").to_pylist()
                for s, hash_ in zip(shingle_sets(part.column("text"), size), ids, strict=True):
                    key = _key(s)
                    at = (key ^ hash_) % WANTED
                    if bitmap[at >> 3] >> (at & 7) & 1:
                        keys.append(key)
                        sets.append((s >> np.uint64(48)).astype(np.uint16).tobytes() if short else s.tobytes())
                columns = [pa.array(keys, pa.int64()), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "shingles"])

    hashed = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.col(id_col)).alias("hash"))
    return hashed.mapInArrow(whole, "key bigint, shingles binary")


def _may_link(n, m, p, q, lanes_n, lanes_m, percent: int) -> np.ndarray:
    """Length, positional and suffix filter for arrays of pairs with a common shingle at p and q.

    The overlap is at most the shorter part before that shingle, itself, and the shorter part after
    it; and at most, in each lane, what both sets have there.
    """
    need = -(-percent * (n + m) // (100 + percent))
    ok = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    ok &= np.minimum(p, q) + 1 + np.minimum(n - p, m - q) - 1 >= need
    at = np.flatnonzero(ok)
    a, b = lanes_n(at), lanes_m(at)
    full = (a == 255).any(axis=1) | (b == 255).any(axis=1)  # counts beyond 255 are not known
    ok[at] = full | (np.minimum(a, b).sum(axis=1, dtype=np.int64) >= need[at])
    return ok


def _column(batch: pa.RecordBatch | pa.Table, name: str, width: int) -> np.ndarray:
    """A binary column of fixed width as a matrix of bytes."""
    joined = b"".join(batch.column(name).to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(batch.num_rows, width)


def _numbers(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) if isinstance(
        batch, pa.RecordBatch) else batch.column(name).to_numpy().astype(np.int64)


PAIR = "a bigint, b bigint"


def _pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def leader_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of each class with the leaders of the shingles it shares, after the filters."""
    leaders = members.where("leads").select(
        "x", F.col("key").alias("key2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"),
        F.col("lanes").alias("lanes2"),
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = _column(batch, "lanes", LANES), _column(batch, "lanes2", LANES)
            n, m, p, q = (_numbers(batch, c) for c in ("n", "n2", "pos", "pos2"))
            ok = _may_link(n, m, p, q, lambda i, a=first: a[i], lambda i, b=second: b[i], percent)
            yield _pairs(_numbers(batch, "key")[ok], _numbers(batch, "key2")[ok])

    own = members.select("x", "key", "n", "pos", "lanes")
    both = own.join(leaders, "x").where(F.col("key") != F.col("key2"))
    return both.drop("x").mapInArrow(keep, PAIR).distinct()


PACKED = "a bigint, b bigint, pairs binary"


def _packed(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """Pairs of class numbers as one row for each two bundles, smaller numbers first."""
    low, high = np.minimum(x, y), np.maximum(x, y)
    first, second = low // BUNDLE, high // BUNDLE
    code = (low % BUNDLE * BUNDLE + high % BUNDLE).astype(np.uint16)
    order = np.lexsort((code, second, first))
    first, second, code = first[order], second[order], code[order]
    cuts = np.flatnonzero(
        np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))[: len(code)]
    )
    lists = [np.unique(part).tobytes() for part in np.split(code, cuts[1:])] if len(code) else []
    return pa.RecordBatch.from_arrays(
        [pa.array(first[cuts]), pa.array(second[cuts]), pa.array(lists, pa.binary())],
        ["a", "b", "pairs"],
    )


def _once(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of class numbers, each once."""
    x, y = np.minimum(x, y), np.maximum(x, y)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[: len(x)]
    return x[new], y[new]


def with_before(members: DataFrame) -> DataFrame:
    """``members`` with the ``BEFORE`` shared shingles before each in its class's prefix, 0 for none."""
    order = Window.partitionBy("key").orderBy("pos")  # no more of a class than its prefix
    lags = {f"before{k}": F.lag("x", k, 0).over(order) for k in range(1, BEFORE + 1)}
    return members.withColumns(lags)


def block_pairs(members: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs with different labels that share a prefix shingle, after the filters, in rows of ``PACKED``.

    The members of a shingle are dealt into blocks, and each two blocks meet in a cell of their own,
    so that a group of any size is spread over many tasks and none holds more than two blocks. Two
    members that share one of the shingles just before as well are left to that shingle's cell, where
    they pass the filters too if their sets are similar enough.
    """
    earlier = [f"before{k}" for k in range(1, BEFORE + 1)]
    known = labels.select(F.col("vertex").alias("key"), "label")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("key", "x"), blocks).cast("int")
    cells = (
        members.join(known, "key", "left")
        .withColumn("label", F.coalesce("label", "key"))
        .withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select("x", "i", "j", "block", "num", "label", "n", "pos", "lanes", *earlier)
        .repartition("x", "i", "j")
        .sortWithinPartitions("x", "i", "j")
    )

    def compare(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rows = table.num_rows
        before = [_numbers(table, c) for c in earlier]
        names = ("x", "i", "j", "block", "n", "pos", "num", "label")
        x, i, j, block, n, pos, keys, label = (_numbers(table, c) for c in names)
        lanes = _column(table, "lanes", LANES)
        group = np.cumsum(
            np.append(0, (x[1:] != x[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
        )
        left, right = [keys[:0]], [keys[:0]]
        for step in range(1, rows):
            a = np.flatnonzero(group[:-step] == group[step:])
            if not len(a):
                break
            b = a + step
            apart = (label[a] != label[b]) & ((i[a] == j[a]) | (block[a] != block[b]))
            a, b = a[apart], b[apart]
            met = np.zeros(len(a), bool)
            for u in before:
                for v in before:
                    met |= (u[a] == v[b]) & (u[a] != 0)
            a, b = a[~met], b[~met]
            ok = _may_link(n[a], n[b], pos[a], pos[b], lambda k, a=a: lanes[a[k]],
                           lambda k, b=b: lanes[b[k]], percent)
            left.append(keys[a[ok]])
            right.append(keys[b[ok]])
        return np.concatenate(left), np.concatenate(right)

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def sides() -> list[np.ndarray]:
            return [np.concatenate(side) for side in zip(*held, strict=True)]

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            last = [table.column(c)[-1].as_py() for c in ("x", "i", "j")] if table.num_rows else None
            if last is None:
                continue
            same = np.ones(table.num_rows, bool)
            for c, v in zip(("x", "i", "j"), last, strict=True):
                same &= table.column(c).to_numpy() == v
            cut = int(np.argmax(same))  # the last cell may go on in the next batch
            if cut:
                held.append(compare(table.slice(0, cut).combine_chunks()))
                if sum(len(x) for x, _ in held) > HELD:
                    held = [_once(*sides())]
                    if len(held[0][0]) > HELD // 2:
                        yield _packed(*held[0])
                        held = [(held[0][0][:0], held[0][1][:0])]
            rest = table.slice(cut)
        if rest is not None:
            held.append(compare(rest.combine_chunks()))
        yield _packed(*sides())

    return cells.mapInArrow(cells_of, PACKED)


def merged(packed: DataFrame) -> DataFrame:
    """``packed`` with each pair once: classes that share many shingles come from many cells."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.frombuffer(p, np.uint16) for p in batch.column("pairs").to_pylist()]
            sizes = list(map(len, codes))
            code = np.concatenate([np.zeros(0, np.uint16), *codes]).astype(np.int64)
            first, second = (np.repeat(_numbers(batch, c), sizes) * BUNDLE for c in ("a", "b"))
            yield _packed(first + code // BUNDLE, second + code % BUNDLE)

    return packed.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(emit, PACKED)


def members_of_pairs(packed: DataFrame) -> DataFrame:
    """``a, b, num``: the classes of two bundles that are in any of their pairs."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second, nums = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("a", "b", "pairs"))
            for a, b, pairs in zip(*columns, strict=True):
                code = np.frombuffer(pairs, np.uint16).astype(np.int64)
                own = np.append(a * BUNDLE + code // BUNDLE, b * BUNDLE + code % BUNDLE)
                nums.append(np.unique(own))
                first.append(np.full(len(nums[-1]), a))
                second.append(np.full(len(nums[-1]), b))
            columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (first, second, nums)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "num"])

    return packed.mapInArrow(emit, "a bigint, b bigint, num bigint").distinct()


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set on the left shares with each on the right."""
    sides = [np.concatenate(side) for side in (left, right)]
    rows = [np.repeat(np.arange(len(side)), list(map(len, side))) for side in (left, right)]
    both = np.intersect1d(distinct(sides[0]), distinct(sides[1]), assume_unique=True)
    found = []
    for x, row in zip(sides, rows, strict=True):
        place = np.minimum(np.searchsorted(both, x), max(0, len(both) - 1))
        shared = both[place] == x if len(both) else np.zeros(len(x), bool)
        found.append((place[shared], row[shared]))
    total = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(both), COLUMNS):
        tables = []
        for (place, row), side in zip(found, (left, right), strict=True):
            near = (place >= at) & (place < at + COLUMNS)
            table = np.zeros((len(side), min(COLUMNS, len(both) - at)), np.float32)
            table[row[near], place[near] - at] = 1
            tables.append(table)
        total += tables[0] @ tables[1].T
    return total


def _told_apart(short: bytes) -> np.ndarray:
    """A sorted multiset of 16-bit numbers as a set: each with how often it came before."""
    x = np.frombuffer(short, np.uint16)
    again = np.arange(len(x)) - np.searchsorted(x, x)
    return x.astype(np.uint64) << np.uint64(32) | again.astype(np.uint64)


def bundle_pairs(packed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of ``packed`` that may link by their short shingles, as keys; ``sets`` are ``num, key, shingles``.

    Of two bundles only the sets come together that are in a pair, each once, however many pairs it is in.
    Sets share at most as many shingles as they have equal short ones, so no link is left out.
    """
    sent = members_of_pairs(packed).join(sets, "num")

    def check(pairs, members):
        held = {n: k for k, n in enumerate(members["num"])}
        keys = members["key"].to_numpy(np.int64)
        own = [_told_apart(s) for s in members["shingles"]]
        size = np.array([len(s) for s in own])
        code = np.unique(np.concatenate([np.frombuffer(p, np.uint16) for p in pairs["pairs"]]))
        code = code.astype(np.int64)
        low = pairs["a"].iloc[0] * BUNDLE + code // BUNDLE
        high = pairs["b"].iloc[0] * BUNDLE + code % BUNDLE
        x, y = (np.array([held[n] for n in side.tolist()]) for side in (low, high))
        if len(code) <= FEW:
            common = [len(np.intersect1d(own[i], own[j], assume_unique=True)) for i, j in zip(x, y)]
        else:
            (us, at), (vs, to) = (np.unique(side, return_inverse=True) for side in (x, y))
            common = overlaps([own[i] for i in us], [own[j] for j in vs])[at, to]
        common = np.array(common, np.int64)
        ok = 100 * common >= percent * (size[x] + size[y] - common)
        return pd.DataFrame({"a": keys[x[ok]], "b": keys[y[ok]]})

    return packed.groupBy("a", "b").cogroup(sent.groupBy("a", "b")).applyInPandas(check, PAIR)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, each compared once."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            columns = (batch.column(c).to_pylist() for c in ("set_a", "set_b"))
            for p, q in zip(*columns, strict=True):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    return (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("set_b")), "b")
        .mapInArrow(check, PAIR)
    )


def jaccard_components(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``.

    Two documents link when 100 times the shingles they share is at least ``percent`` times those
    either has; ``component_id`` is the smallest id that links lead to. A text shorter than ``size``
    words is one shingle. A text that is null or has no words has no shingles and links with nothing,
    nor does a document count as linked with others without words. Texts are read whole. Documents
    with equal sets always link; null ids do not name a component unless there is no other id in it.
    An id that comes twice counts for each of its texts. No rows give no rows. Sets are told apart by
    64-bit hashes: of n different ones about n * n / 2**65 pairs would be taken for equal.
    """
    sets = saved(shingle_prefixes(docs, id_col, text_col, size, percent), "prefixes")
    entries = sets.select("key", "n", F.posexplode("prefix").alias("pos", "x"))
    ends = entries.groupBy("x").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    several = saved(ends.where("low != high").select("x"), "shared")
    shared = saved(entries.join(several, "x", "left_semi").distinct(), "members")
    # The leader of a shingle: the class with the fewest rarer shingles, then by hash.
    rank = F.col("pos").cast("bigint") * (1 << 40) + F.pmod(F.xxhash64("key"), F.lit(1 << 40))
    groups = shared.groupBy("x").agg(F.count("*").alias("count"), F.min(rank).alias("first"))
    lanes = sets.where("lanes IS NOT NULL").groupBy("key").agg(
        F.first("lanes").alias("lanes"), F.first(F.col("prefix")[0]).alias("rarest")
    )
    # Numbered in ranges of the rarest shingle; numbers have gaps between ranges.
    ranges = lanes.repartitionByRange("rarest", "key").sortWithinPartitions("rarest", "key")
    lanes = saved(ranges.select("key", "lanes", F.monotonically_increasing_id().alias("num")), "lanes")
    members = (
        shared.join(saved(groups, "groups"), "x")
        .withColumn("leads", rank == F.col("first"))
        .drop("first")
        .join(lanes, "key")
    )
    members = saved(with_before(members), "members_lanes")
    classes = sets.where("n > 0").groupBy("key").agg(F.min("_id").alias("rep"))
    classes = saved(classes, "classes")

    def whole(keys: DataFrame, name: str, short: bool = False) -> DataFrame:
        """The sets of the classes in a relation ``key``."""
        wanted = saved(classes.join(keys.distinct(), "key"), f"{name}_wanted")
        return saved(wanted_sets(docs, wanted, id_col, text_col, size, short), f"{name}_sets")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.select(F.col("a").alias("key")).union(pairs.select("b"))
        return saved(verified(pairs, whole(both, name), percent), f"{name}_links")

    links = linked(saved(leader_pairs(members, percent), "leader_pairs"), "leader")
    rest = saved(merged(block_pairs(members, components(links), percent)), "block_pairs")
    nums = members_of_pairs(rest).select("num").distinct()
    keys = saved(lanes.select("num", "key").join(nums, "num"), "block_keys")
    short = whole(keys.select("key"), "block", short=True).dropDuplicates(["key"])  # some fall on the same bits
    near = saved(bundle_pairs(rest, keys.join(short, "key"), percent), "near_pairs")
    more = linked(near, "near")
    labels = components(links.union(more)).withColumnRenamed("vertex", "key")
    named = classes.join(labels, "key", "left")
    named = saved(named.withColumn("label", F.coalesce("label", "key")), "labelled")
    least = saved(named.groupBy("label").agg(F.min("rep").alias("component_id")), "least")
    of_key = saved(named.join(least, "label").select("key", "component_id"), "of_key")
    return (
        sets.select("_id", "key", "n")
        .join(of_key, "key", "left")
        .select(
            F.col("_id").alias(id_col),
            F.col("n").cast("bigint").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id"))
            .otherwise(F.col("_id"))
            .alias("component_id"),
        )
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id.

    All columns are returned as they came. Documents without words all stay. Rows that repeat an id
    stay or go together.
    """
    kept = (
        jaccard_components(docs, id_col=id_col, text_col=text_col, **how)
        .where(F.col(f"`{id_col}`").eqNullSafe(F.col("component_id")))
        .select(F.struct(F.col(f"`{id_col}`").alias("id")).alias("kept"))
        .distinct()
    )
    # The rows go through the join as one column, so no name of theirs meets one of this function's.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    own = F.struct(F.col("row").getField(id_col).alias("id"))
    found = rows.join(kept, own == F.col("kept"), "left_semi")
    return found.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
