"""Near-duplicate passages by compact windows.

The tokens are five-word shingles of whole texts. For one hash function, all stretches of a text of at
least ``LEAST`` words fall into compact windows: those whose smallest hash is at one place. The windows
are the nodes of the Cartesian tree of the hashes that are long enough, so there are about 2 n / LEAST
of them. Two texts that have a passage in common have, for each hash function, a window with the same
shingle at its smallest hash. A window's signature is that shingle with those four places before and
behind it, which a passage without a change nearby leaves alone. Only the centres of the windows are
needed, and a node of the tree is long enough just if its hash is the smallest of some ``LEAST`` words in a
row; so the centres are found as sliding minima and the tree is not built.

Windows of equal signature are brought together in shards by a hash of the signature. In a group each
text is paired with the group's first text and with the one before it (by a hash of the whole text), so a
passage in very many texts gives two pairs a text and not all pairs. A pair found under any signature
is verified once: the stretches of one text are sought whose shingles are nearly all in the other. Groups in
which verified links do not join all texts at the signature's place are looked at again: every two members that
are not joined are compared by the shingles around those places. In a group of more than ``MEMBERS`` members meet by
rare shingles or in cells, which leads to the same pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, IntegralType, LongType, StringType, StructField, StructType

from topicloom.llm.blocks import pack, unpack
from topicloom.llm.components import components
from topicloom.llm.words import Words, distinct, mix, shingles, slices, text_buffer, words
from topicloom.operators.skew import skew_join
from topicloom.session import saved, saved_at, scratch_path, scratch_scope

SHINGLE = 5
LEAST = 50  # words of a passage
HASHES = 8
SHARDS = 32  # at least
SHARD_BYTES = 256 << 20  # of text per shard beyond that
SLICE = 8 << 20
AROUND = 4  # shingles before and behind that are part of a signature
BLOCK = 1 << 19  # tokens whose minima are sought at once
MEMBERS = 512  # that are compared in one cell
SOME = 256  # members of a large group, about, from which its common shingles are learned
APART = 64  # share of a large group's pairs, its inverse, that may meet by rare values
FEW = 32  # members with a rare value that are paired at once; more are compared in cells
SHARD_MEMBERS = 1 << 14  # of large groups
COLUMNS = 1024  # shingles of a cell that are compared at once
CELL = 1 << 24  # words of pairs, with ``PAIR`` for each, that are verified in one cell
PAIR = 1 << 10
CELLS = 128  # shards of cells, at least
SHARD_CELLS = 1 << 25  # words of pairs per shard beyond that
COMPARED = 1 << 20  # shingles that are sought at once
BUCKET = 1 << 15  # bits in one of Spark's bitmaps
WANTED = 1 << 26  # bits of a bitmap of what is wanted, at most; 16 for each before
_PLACE = np.uint64((1 << 20) - 1)


def text_ids(found: Words) -> list[bytes]:
    """128-bit hashes of the texts' sequences of words."""
    first = found.first()
    return [
        xxhash.xxh3_128_digest(found.hash[a:b].tobytes())
        for a, b in zip(first[:-1], first[1:], strict=True)
    ]


def window_centres(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, least: int) -> np.ndarray:
    """Places of the smallest hash of each compact window of at least ``least`` tokens.

    ``start`` and ``end`` bound the texts, which lie behind one another. Of equal hashes the first counts.
    ``least`` must be below ``BLOCK``.
    """
    out = [np.zeros(0, np.int64)]
    last = np.repeat(end, end - start)
    for at in range(0, len(hashes) - least + 1, BLOCK):
        part = hashes[at : at + BLOCK + least - 1]
        low = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        reach = 1
        while reach < least:
            step = min(reach, least - reach)
            low, reach = np.minimum(low[:-step], low[step:]), reach + step
        first = np.arange(at, at + len(low))
        place = (low[first + least <= last[first]] & _PLACE).astype(np.int64) + at
        out.append(place[np.append(True, place[1:] != place[:-1])[: len(place)]])
    return np.unique(np.concatenate(out))


def signatures(found: Words, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The signatures of each text, with the text's row and the place of the centre in it."""
    x, doc, _ = shingles(found, SHINGLE)
    bounds = np.searchsorted(doc, np.arange(found.docs + 1))
    chosen = np.zeros(len(x), bool)
    for i in range(HASHES):
        seed = mix(np.array([i + 1], dtype=np.uint64))
        chosen[window_centres(mix(x ^ seed), bounds[:-1], bounds[1:], least - SHINGLE + 1)] = True
    k = np.flatnonzero(chosen)
    own, before, behind = doc[k], k - AROUND, k + AROUND
    none = np.uint64(0)
    left = np.where(before >= bounds[own], x[np.maximum(before, 0)], none)
    right = np.where(behind < bounds[own + 1], x[np.minimum(behind, len(x) - 1)], none)
    return mix(mix(left * np.uint64(3) + x[k]) * np.uint64(5) + right), own, k - bounds[own]


BLOCKS = "key binary, id bigint, n int, shard int, keys binary, rows binary, ids binary, places binary"


def texts_and_blocks(named: DataFrame, shards: int, least: int) -> DataFrame:
    """What is needed of each text ``text`` with its id ``_id``, in one reading.

    A row per text of at least ``least`` words (``key``, ``id``: 128 and 64 bits of its hash, ``n``: its
    words), and rows of packed signatures per shard with the ids of the texts that have them.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = words(part.column("text"))
                keys = text_ids(found)
                ids = np.frombuffer(b"".join(t[:8] for t in keys), np.uint64)
                size = np.diff(found.first())
                long = np.flatnonzero(size >= least)
                count = len(long)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id").take(pa.array(long)), pa.array([keys[i] for i in long], pa.binary()),
                        pa.array(ids[long].view(np.int64)), pa.array(size[long].astype(np.int32)),
                        pa.nulls(count, pa.int32()), *[pa.nulls(count, pa.binary())] * 4,
                    ], schema.names,
                )
                key, row, place = signatures(found, least)
                shard = (mix(key) % np.uint64(shards)).astype(np.int64)
                order = np.lexsort((key, shard))
                key, row, shard, place = key[order], row[order], shard[order], place[order]
                made = []
                cut = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    used, at = np.unique(row[a:b], return_inverse=True)
                    made.append(
                        (int(shard[a]), pack(key[a:b], True), pack(at), pack(ids[used]), pack(place[a:b]))
                    )
                if made:
                    columns = [pa.array(c) for c in zip(*made, strict=True)]
                    columns[0] = columns[0].cast(pa.int32())
                    count = len(made)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.nulls(count, part.column("_id").type), pa.nulls(count, pa.binary()),
                            pa.nulls(count, pa.int64()), pa.nulls(count, pa.int32()), *columns,
                        ], schema.names,
                    )

    schema = StructType(
        [StructField("_id", named.schema["_id"].dataType)] + StructType.fromDDL(BLOCKS).fields
    )
    return named.mapInArrow(emit, schema)


def candidate_pairs(blocks: DataFrame) -> DataFrame:
    """``a`` and ``b``: 64-bit ids of texts that share a signature, as the module says; ``place`` is -1.

    Of groups with pairs beside those, all members: ``a`` the id, ``b`` the signature, ``place`` its place.
    """

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([unpack(k, True) for k in pdf["keys"]])
        ids = np.concatenate(
            [unpack(i)[unpack(r).astype(np.int64)] for r, i in zip(pdf["rows"], pdf["ids"], strict=True)]
        )
        places = np.concatenate([unpack(p).astype(np.int32) for p in pdf["places"]])
        order = np.argsort(keys, kind="stable")
        keys, ids, places = keys[order], ids[order], places[order]
        again = np.zeros(len(keys), bool)  # only signatures that come twice
        again[1:] = keys[1:] == keys[:-1]
        again[:-1] |= again[1:]
        keys, ids, places = keys[again], ids[again], places[again]
        order = np.lexsort((ids, keys))
        keys, ids, places = keys[order], ids[order], places[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))[: len(keys)]
        group = np.cumsum(np.append(True, keys[1:] != keys[:-1])[: len(keys)]) - 1
        many = np.bincount(group[new])[group] > 3 if len(keys) else new  # three are all paired
        members = pd.DataFrame(
            {"a": ids[many].view(np.int64), "b": keys[many].view(np.int64), "place": places[many]}
        )
        keys, ids = keys[new], ids[new]
        first = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
        leader = ids[np.flatnonzero(first)][np.cumsum(first) - 1] if len(ids) else ids
        member = np.flatnonzero(~first)
        pairs = np.concatenate(
            [np.stack([leader[member], ids[member]], 1), np.stack([ids[member - 1], ids[member]], 1)]
        )
        pairs = np.unique(pairs, axis=0).view(np.int64)
        pairs = pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "place": np.int32(-1)})
        return pd.concat([pairs, members.drop_duplicates()])

    rows = blocks.where("shard IS NOT NULL").select("shard", "keys", "rows", "ids", "places")
    return rows.groupBy("shard").applyInPandas(meet, "a bigint, b bigint, place int")


def remaining_pairs(members: DataFrame, places: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Pairs of a signature's members (``id``, ``key``, ``place``) that no verified links join there.

    The rule is that of ``near_pairs`` whatever the size of a group. A group of more than ``MEMBERS`` texts is
    cut for it, see ``cut_pairs``: that bounds a task and decides nothing.
    """
    inside = (F.col("place") >= F.col("low")) & (F.col("place") + SHINGLE <= F.col("high"))
    labelled = (
        members.join(places.withColumnRenamed("id", "of"), (F.col("id") == F.col("of")) & inside, "left")
        .groupBy("key", "id", "place")
        .agg(F.coalesce(F.min("passage"), F.xxhash64("id")).alias("label"))
        .groupBy("key", "id")
        .agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.collect_list("place").alias("places")
        )
    )
    labelled = saved(labelled, "passage_labels")
    groups = labelled.groupBy("key").agg(
        F.min("lo").alias("least"), F.max("hi").alias("most"), F.count("*").alias("count")
    )
    apart = saved(groups.where("least != most and count > 1").select("key", "count"), "passage_apart")
    small = surroundings(labelled, apart.where(F.col("count") <= MEMBERS), texts, least)
    large = surroundings(labelled, apart.where(F.col("count") > MEMBERS), texts, least)
    size = apart.where(F.col("count") <= MEMBERS).agg(F.sum("count")).first()[0] or 0
    shards = max(SHARDS, -(-size // SHARD_MEMBERS))
    small = small.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    near = near_pairs(small, ["shard"], least)
    return near.union(cut_pairs(saved(large, "passage_large"), least)).distinct()


NEAR = "key bigint, id bigint, lo bigint, hi bigint, count bigint, near binary"


def surroundings(labelled: DataFrame, groups: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """The members of some groups with ``near``, the shingles around a signature's places in the text.

    A passage can be cut into passages of less than twice ``least``, so only the shingles that near to a
    place count.
    """
    reach = 2 * (least - SHINGLE + 1) - 2

    def around(x: np.ndarray, places: list[int]) -> bytes:
        if len(places) == 1:
            return x[max(0, places[0] - reach) : places[0] + reach + 1].tobytes()
        place = np.array(places)
        edge = np.zeros(len(x) + 1, np.int64)
        np.add.at(edge, np.maximum(place - reach, 0), 1)
        np.add.at(edge, np.minimum(place + reach + 1, len(x)), -1)
        return x[np.cumsum(edge)[:-1] > 0].tobytes()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, FEW):
                part = batch.slice(at, FEW)
                own = part.column("own").flatten()
                row = np.repeat(np.arange(part.num_rows), part.column("own").value_lengths())
                texts = [np.frombuffer(x.as_buffer(), np.uint32) for x in part.column("x")]
                near = [around(texts[r], p) for r, p in zip(row, own.field("places").to_pylist(), strict=True)]
                key, lo, hi, count = (own.field(c) for c in ("key", "lo", "hi", "count"))
                ids = part.column("id").take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [key, ids, lo, hi, count, pa.array(near, pa.binary())], names
                )

    names = [c.split()[0] for c in NEAR.split(", ")]
    own = labelled.join(groups, "key").groupBy("id")
    own = saved(own.agg(F.collect_list(F.struct("key", "lo", "hi", "count", "places")).alias("own")), "passage_own")
    return own.join(among(texts, "id", own, "id"), "id").mapInArrow(emit, NEAR)


def needed(least: int) -> int:
    """Shingles around a signature that each side needs on the other: eight ninths of the least passage."""
    return -(-8 * (least - SHINGLE + 1) // 9)


def pairs_apart(
    parts: list[np.ndarray], ids: np.ndarray, lo: np.ndarray, hi: np.ndarray, need: int
) -> np.ndarray:
    """Pairs of ids whose shingles have ``need`` in common on either side and which have not one label alone.

    Members that only have the most common label are not compared with one another.
    """
    n = len(parts)
    row = np.repeat(np.arange(n), [len(c) for c in parts])
    at, values = pd.factorize(np.concatenate(parts))
    at, count = at.astype(np.int64), len(values)
    texts_with = np.bincount(distinct(at * n + row) // n, minlength=count)
    both = texts_with[at] > 1
    row, at, count = row[both], (np.cumsum(texts_with > 1) - 1)[at[both]], int((texts_with > 1).sum())
    labels, times = np.unique(lo[lo == hi], return_counts=True)
    rest = np.ones(n, bool)
    if len(labels):
        rest = (lo != hi) | (lo != labels[times.argmax()])
    if 2 * rest.sum() >= n:
        rest[:] = True
    some = np.flatnonzero(rest)
    here = np.zeros((len(some), n), np.float32)  # places of some members whose value another one has
    there = here if len(some) == n else here.copy()  # places of the other one
    for low in range(0, count, COLUMNS):
        inside = (at >= low) & (at < low + COLUMNS)
        width = min(COLUMNS, count - low)
        times = np.bincount(row[inside] * width + at[inside] - low, minlength=n * width)
        times = times.reshape(n, width).astype(np.float32)
        has = (times > 0).astype(np.float32)
        here += times[some] @ has.T
        if len(some) < n:
            there += has[some] @ times.T
    if len(some) == n:
        there = here.T
    p, q = np.nonzero(np.minimum(here, there) >= need)
    p = some[p]
    once = (p < q) | ~rest[q]
    p, q = p[once], q[once]
    apart = (np.minimum(lo[p], lo[q]) != np.maximum(hi[p], hi[q])) & (ids[p] != ids[q])
    return np.stack([ids[p[apart]], ids[q[apart]]], 1)


def near_pairs(members: DataFrame, cell: list[str], least: int) -> DataFrame:
    """Pairs of one group's members in a cell that have enough shingles around the signature in common."""
    need = needed(least)

    def all_groups(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")
        key, ids, lo, hi = (pdf[c].to_numpy().astype(np.int64) for c in ("key", "id", "lo", "hi"))
        parts = [np.frombuffer(c, np.uint32) for c in pdf["near"]]
        cut = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
        found = [
            pairs_apart(parts[a:b], ids[a:b], lo[a:b], hi[a:b], need)
            for a, b in zip(cut[:-1], cut[1:], strict=True)
        ]
        pairs = np.sort(np.concatenate(found).view(np.uint64), axis=1)  # as in candidate_pairs
        pairs = np.unique(pairs, axis=0).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return members.groupBy(*cell).applyInPandas(all_groups, "a bigint, b bigint").distinct()


def rare_values(near: np.ndarray, common: np.ndarray, need: int) -> np.ndarray:
    """The distinct values of all but the last ``need`` - 1 places in the order of ``common``.

    Others come first. Of two texts with ``need`` places each whose values the other has, the first of those
    values in that order is among these values of both.
    """
    order = np.argsort(common, kind="stable")
    rising = common[order]
    known = is_among(near, rising)
    rank = np.zeros(len(near), np.int64)
    rank[known] = order[np.searchsorted(rising, near[known])] + 1
    return np.unique(near[np.lexsort((near, rank))][: max(0, len(near) - need + 1)])


def cut_pairs(large: DataFrame, least: int) -> DataFrame:
    """The pairs of ``near_pairs`` for groups of any size, without a task that takes a whole group.

    The most common shingles of a group are learned from some of its members. Where others tell the members
    apart, only those meet that share one of their rare values, see ``rare_values``. Elsewhere members meet in
    cells of two blocks. What is learned decides only between ways to the same pairs.
    """
    need = needed(least)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(c, np.uint32) for c in pdf["near"]]
        values, times = np.unique(np.concatenate([np.unique(c) for c in parts]), return_counts=True)
        common = values[times > 1][np.argsort(times[times > 1], kind="stable")]
        _, met = np.unique(np.concatenate([rare_values(c, common, need) for c in parts]), return_counts=True)
        rare = bool((met[met > 1] ** 2).sum() * APART <= len(parts) ** 2)
        return pd.DataFrame({"key": pdf["key"][:1], "common": [common.tobytes()], "rare": [rare]})

    some = F.pmod(F.xxhash64("id"), F.ceil(F.col("count") / SOME)) == 0
    learned = large.where(some).groupBy("key").applyInPandas(learn, "key bigint, common binary, rare boolean")
    learned = saved(learned, "passage_common")
    shards = max(SHARDS, -(-large.count() // SHARD_MEMBERS))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, common = (
                [np.frombuffer(c.as_buffer(), np.uint32) for c in batch.column(name)]
                for name in ("near", "common")
            )
            found = [rare_values(x, c, need) for x, c in zip(near, common, strict=True)]
            row = np.repeat(np.arange(len(found)), [len(c) for c in found])
            if not len(row):
                continue
            key, ids = (batch.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("key", "id"))
            value = mix(key[row] ^ mix(np.concatenate(found).astype(np.uint64) + np.uint64(1)))
            shard = (value % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            value, row, shard = value[order], row[order], shard[order]
            cut = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
            made = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                used, at = np.unique(row[a:b], return_inverse=True)
                columns = value[a:b], at.astype(np.uint32), key[used], ids[used]
                made.append((int(shard[a]), *(c.tobytes() for c in columns)))
            kinds = [pa.int32(), *[pa.binary()] * 4]
            columns = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "values", "rows", "keys", "ids"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        value = np.concatenate([np.frombuffer(c, np.uint64) for c in pdf["values"]])
        rows = [np.frombuffer(c, np.uint32) for c in pdf["rows"]]
        key, ids = (
            np.concatenate([np.frombuffer(c, np.uint64)[r] for c, r in zip(pdf[name], rows, strict=True)])
            for name in ("keys", "ids")
        )
        order = np.lexsort((ids, value))
        value, key, ids = value[order], key[order], ids[order]
        size = np.diff(np.append(np.flatnonzero(np.append(True, value[1:] != value[:-1])), len(value)))
        size = np.repeat(size, size)
        crowd = size > FEW
        value, key, ids, size = (
            np.concatenate([c[~crowd], c[crowd]]) for c in (value, key, ids, size)
        )
        few = int((~crowd).sum())
        pairs = [np.zeros((0, 3), np.uint64)]
        for step in range(1, FEW):
            first = np.flatnonzero(value[: max(0, few - step)] == value[step : max(few, step)])
            pairs.append(np.stack([key[first], ids[first], ids[first + step]], 1))
        pairs = np.unique(np.concatenate(pairs), axis=0).view(np.int64)
        none = np.zeros(len(pairs), np.int64)
        met = pd.DataFrame({"key": pairs[:, 0], "a": pairs[:, 1], "b": pairs[:, 2], "value": none, "size": none})
        value, key, ids = (c[few:].view(np.int64) for c in (value, key, ids))
        crowd = pd.DataFrame({"key": key, "a": ids, "b": ids, "value": value, "size": size[few:]})
        return pd.concat([met, crowd])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            enough = np.zeros(batch.num_rows, bool)
            for row in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[row].as_buffer(), np.uint32) for c in ("x", "y"))
                enough[row] = is_among(x, distinct(y)).sum() >= need <= is_among(y, distinct(x)).sum()
            yield batch.select(["a", "b"]).filter(pa.array(enough))

    apart = large.join(learned.where("rare"), "key").mapInArrow(
        emit, "shard int, values binary, rows binary, keys binary, ids binary"
    )
    met = apart.groupBy("shard").applyInPandas(meet, "key bigint, a bigint, b bigint, value bigint, size bigint")
    met = saved(met, "passage_cut")
    left = large.select("key", F.col("id").alias("a"), "lo", "hi", F.col("near").alias("x"))
    right = large.select(
        "key", F.col("id").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"),
        F.col("near").alias("y"),
    )
    pairs = met.where("size = 0").select("key", "a", "b").distinct().join(left, ["key", "a"])
    pairs = pairs.join(right, ["key", "b"]).where("least(lo, lo_b) != greatest(hi, hi_b)")
    pairs = pairs.select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint")
    crowds = met.where("size > 0").select("key", F.col("a").alias("id"), "value")
    whole = large.join(learned.where("rare"), "key", "left_anti")
    whole = whole.select("key", "id", F.lit(0).cast("long").alias("value"))
    labels = large.where("lo = hi").groupBy("key", "lo").count().groupBy("key")
    labels = labels.agg(F.max(F.struct("count", "lo")).getField("lo").alias("most"))
    # Members that only have a group's most common label meet the others and not one another.
    cells = crowds.union(whole).distinct().join(large.select("key", "id", "lo", "hi").distinct(), ["key", "id"])
    cells = cells.join(labels, "key", "left")
    rest = F.coalesce((F.col("lo") != F.col("most")) | (F.col("hi") != F.col("most")), F.lit(True))
    cells = cells.select("key", "id", "value", rest.alias("rest"))
    size = cells.groupBy("key", "value").agg(
        F.count_if("rest").alias("rest_of"), F.count_if(~F.col("rest")).alias("most_of")
    )
    rest_of, most_of = (F.ceil(2 * F.col(c) / MEMBERS) for c in ("rest_of", "most_of"))
    cells = cells.join(size, ["key", "value"]).withColumns({"rest_of": rest_of, "most_of": most_of})
    cells = cells.where("rest_of > 0")
    block = F.when(F.col("rest"), F.pmod(F.xxhash64("id"), F.col("rest_of")))
    block = block.otherwise(F.col("rest_of") + F.pmod(F.xxhash64("id"), F.col("most_of")))
    upto = F.col("rest_of") + F.when(F.col("rest"), F.col("most_of")).otherwise(0) - 1
    cells = cells.withColumn("one", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), upto)))
    cells = cells.select(
        "key", "id", "value", F.least("one", "other").alias("one"), F.greatest("one", "other").alias("other")
    )
    cells = cells.join(large.select("key", "id", "lo", "hi", "near"), ["key", "id"])
    return pairs.union(near_pairs(cells, ["key", "value", "one", "other"], least))


def window_hashes(x: np.ndarray, tokens: int) -> np.ndarray:
    """A hash of each ``tokens`` neighbouring tokens."""
    h, reach = mix(x.astype(np.uint64) + np.uint64(1)), 1
    if len(h) < tokens:
        return h[:0]
    while reach < tokens:
        step = min(reach, tokens - reach)
        h, reach = mix(h[:-step] * np.uint64(3) + h[step:]), reach + step
    return h


def exact_pairs(labelled: DataFrame, large: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Pairs of members of ``large`` groups that have ``least`` words around the signature in common.

    ``repeated_passages`` no longer uses it, as it leaves out passages with changes. Each text is paired with the shortest one that has the same words, so there is at most one pair for
    each word near a signature, however many texts have them, and each pair is a link.
    """
    tokens = least - SHINGLE + 1

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, places in enumerate(batch.column("places")):
                x = np.frombuffer(batch.column("x")[row].as_buffer(), np.uint32)
                all_windows = window_hashes(x, tokens)
                if not len(all_windows):
                    continue
                place = places.values.to_numpy().astype(np.int64)
                edge = np.zeros(len(x) + 1, np.int64)
                np.add.at(edge, np.maximum(place - tokens + 1, 0), 1)
                np.add.at(edge, place + 1, -1)
                h = distinct(all_windows[np.cumsum(edge)[: len(all_windows)] > 0])
                ids = np.full(len(h), batch.column("id")[row].as_py())
                size = np.full(len(h), len(x), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(ids), pa.array(size)], ["w", "id", "size"]
                )

    own = labelled.join(large, "key").groupBy("id").agg(F.collect_set("place").alias("places"))
    windows = own.join(texts, "id").mapInArrow(emit, "w bigint, id bigint, size int")
    windows = saved(windows, "passage_windows")
    shortest = windows.groupBy("w").agg(F.min(F.struct("size", "id")).alias("to"), F.count("*").alias("n"))
    shortest = shortest.where("n > 1").select("w", F.col("to.id").alias("to"))
    met = skew_join(windows.select("w", "id"), shortest, "w").where("id != to").select("id", "to").distinct()
    order = F.col("id").bitwiseXOR(F.lit(-(1 << 63))) < F.col("to").bitwiseXOR(F.lit(-(1 << 63)))
    return met.select(
        F.when(order, F.col("id")).otherwise(F.col("to")).alias("a"),
        F.when(order, F.col("to")).otherwise(F.col("id")).alias("b"),
    ).distinct()


def is_among(x: np.ndarray, rising: np.ndarray) -> np.ndarray:
    """Whether each of ``x`` is among some sorted numbers."""
    if not len(rising):
        return np.zeros(len(x), bool)
    return rising[np.minimum(np.searchsorted(rising, x), len(rising) - 1)] == x


def stretches(there: np.ndarray, cut: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of at least ``least`` tokens of which eight ninths are ``there``: the text's row, start and end.

    The texts lie behind one another, bounded by ``cut``. Stretches begin and end with a token that is there,
    and none lies in a longer one; two may overlap.
    """
    size = np.diff(cut)
    before, behind = np.zeros_like(there), np.zeros_like(there)
    before[1:], behind[:-1] = there[:-1], there[1:]
    before[cut[:-1][size > 0]] = behind[cut[1:][size > 0] - 1] = False
    start, end = np.flatnonzero(there & ~before), np.flatnonzero(there & ~behind) + 1
    if not len(start):
        return start, start, end
    row = np.searchsorted(cut, start, "right") - 1
    new = np.append(True, row[1:] != row[:-1])
    inside = np.cumsum(end - start)
    after = 9 * inside - 8 * end  # the share is enough from one run to another if this does not fall
    before = 9 * (inside - (end - start)) - 8 * start
    # Of a text before another all are larger, so that one search does for all texts.
    apart = (row[-1] - row) * (18 * int(size.max()) + 1) - before[new][np.cumsum(new) - 1]
    most = np.maximum.accumulate((after + apart)[::-1])
    reach = len(after) - 1 - np.searchsorted(most, before + apart)  # the last run that is enough
    longest = np.append(True, reach[1:] > np.maximum.accumulate(reach)[:-1])
    row, start, end = row[longest], start[longest], end[reach[longest]]
    enough = end - start >= least
    row, start, end = row[enough], start[enough], end[enough]
    return row, start - cut[row], end - cut[row]


def common_stretches(x: np.ndarray, other: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of ``x`` of at least ``least`` tokens of which eight ninths are among ``other``'s.

    With as many tokens on the other side that is a Jaccard similarity of 0.8. ``other`` is sorted.
    """
    _, start, end = stretches(is_among(x, other), np.array([0, len(x)]), least)
    return list(zip(start.tolist(), end.tolist(), strict=True))


def roots(count: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For each of ``count`` places the first one that the links ``p`` to ``q`` lead to."""
    root = np.arange(count)
    while len(p):
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (root[root] != root).any():
            root = root[root]
        p, q = root[p], root[q]
        p, q = p[p != q], q[p != q]
    return root


def shared_spans(code: np.ndarray, cut: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Rows ``a``, ``start``, ``end``, ``b``, ``start``, ``end``: the passages that pairs of texts share.

    For each stretch of ``b`` whose tokens are nearly all in ``a`` the stretches of ``a`` whose tokens are
    nearly all in that.
    """
    size, marks, mark = np.diff(cut), np.zeros(int(code.max(initial=-1)) + 1, np.int64), 0
    texts = [code[p:q] for p, q in zip(cut[:-1], cut[1:], strict=True)]

    def sought(own: np.ndarray, among: Iterator[np.ndarray | None]) -> tuple[np.ndarray, ...]:
        """The stretches of ``own`` texts among tokens; None for those of the text before."""
        nonlocal mark
        bounds = np.append(0, np.cumsum(size[own]))
        there = np.empty(bounds[-1], bool)
        for text, other, p, q in zip(own.tolist(), among, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if other is not None:
                mark += 1
                marks[other] = mark
            np.equal(marks[texts[text]], mark, out=there[p:q])
        return stretches(there, bounds, least)

    def parts(own: np.ndarray) -> Iterator[tuple[int, int]]:
        at = (np.cumsum(size[own]) - size[own]) // COMPARED
        edge = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
        yield from zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)

    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    found = [np.zeros((6, 0), np.int64)]
    for low, high in parts(b):
        new = np.append(True, a[low + 1 : high] != a[low : high - 1])
        among = (texts[k] if n else None for k, n in zip(a[low:high].tolist(), new.tolist(), strict=True))
        row, start, end = sought(b[low:high], among)
        x, y = a[low:high][row], b[low:high][row]
        for first, last in parts(x):
            ends = zip(y[first:last].tolist(), start[first:last].tolist(), end[first:last].tolist(), strict=True)
            back, u, v = sought(x[first:last], (texts[k][p:q] for k, p, q in ends))
            back += first
            found.append(np.stack([x[back], u, v + SHINGLE - 1, y[back], start[back], end[back] + SHINGLE - 1]))
    return np.concatenate(found, axis=1)


def among(
    rows: DataFrame, name: str, wanted: DataFrame, wanted_name: str,
    then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter, schema: StructType | None = None,
) -> DataFrame:
    """``rows`` without most of those whose column ``name`` is not in ``wanted``'s, for a join of both.

    What is wanted is sent to all tasks as a bitmap of bounded size, so that the other rows stay where they
    are. Some others fall on the same bits and meet nothing in the join. ``then`` makes rows of ``schema`` of what
    is left in the same Python worker, as another one for each task would take memory of its own.
    """
    size = BUCKET
    while size < min(WANTED, 16 * wanted.count()):
        size *= 2
    place = F.pmod(F.xxhash64(wanted_name), F.lit(size)) + 1
    bits = wanted.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
    bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    table = np.zeros((size // BUCKET, BUCKET // 8), np.uint8)
    for row in bits:
        table[row.bucket - 1] = np.frombuffer(bytes(row.bits), np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(table.ravel())

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            at = batch.column("_at").to_numpy()
            there = bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1
            yield batch.drop_columns(["_at"]).filter(pa.array(there.astype(bool)))

    at = F.pmod(F.xxhash64(name), F.lit(size))
    return rows.withColumn("_at", at).mapInArrow(lambda batches: then(left(batches)), schema or rows.schema)


def dealt_pairs(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """``pairs`` with the ``shard`` in which they are verified and ``near``, a text that they are near to.

    Pairs around the same text come together, so that a text is sent once and not with each of its pairs.
    Many are cut into cells of two blocks of texts. ``sizes`` has each text's ``id`` and ``n`` words.
    """
    ends = pairs.select(F.col("a").alias("id"), F.col("b").alias("to")).union(pairs.select("b", "a"))
    near = ends.groupBy("id").agg(F.least("id", F.min("to")).alias("near"))
    near = ends.join(near.withColumnRenamed("id", "to"), "to").groupBy("id").agg(F.min("near").alias("near"))
    for _ in range(2):
        near = saved(near, "passage_near")
        further = near.select(F.col("id").alias("near"), F.col("near").alias("further"))
        near = near.join(further, "near").select("id", F.least("near", "further").alias("near"))
    near = near.join(sizes, "id")
    dealt = pairs.join(near.withColumnsRenamed({"id": "a", "n": "n_a"}), "a")
    dealt = dealt.join(sizes.withColumnsRenamed({"id": "b", "n": "n_b"}), "b")
    weight = (F.col("n_a") + F.col("n_b") + PAIR).cast("long").alias("weight")
    dealt = saved(dealt.select("a", "b", "near", weight), "passage_dealt")
    total = dealt.agg(F.sum("weight")).first()[0] or 0
    shards = max(CELLS, -(-total // SHARD_CELLS))
    cell = max(CELL, total // 512)
    many = dealt.groupBy("near").agg(F.sum("weight").alias("sum")).where(F.col("sum") > cell)
    many = many.select("near", F.ceil(F.sqrt(2 * F.col("sum") / cell)).alias("blocks"))  # one in a cell's weight
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))  # of neighbouring ids, as candidate_pairs pairs neighbours
    one, other = (F.shiftright((F.shiftright(c, 32) + (1 << 31)) * blocks, 32) for c in "ab")
    shard = F.pmod(F.xxhash64("near", F.least(one, other), F.greatest(one, other)), F.lit(shards))
    dealt = dealt.join(F.broadcast(many), "near", "left").select(shard.alias("shard"), "near", "a", "b")
    return saved(dealt, "passage_cells")


def verified_spans(pairs: DataFrame, texts: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """Spans in words of the passages that pairs of texts share, from both sides.

    ``texts`` has the ``id``, ``like_id`` and ``x``, the shingles in order as 32-bit hashes; a passage needs the
    hashes of eight ninths of its shingles to agree. ``reps`` has each ``id``'s ``rep``, the ``like_id`` that counts,
    and ``n`` words. A row per span of a text (``id``, ``start``, ``end``) and task
    with the least other one (``like_id``, ``like_start``, ``like_end``); of ids that Arrow may order in another
    way than Spark, a row per other one. Verified links lead from each place (spans that overlap by ``least``
    words or more) to all with the same ``joined``, a 64-bit hash that stands in one row of a place.
    """
    kind = texts.schema["like_id"].dataType
    ordered = isinstance(kind, IntegralType) or kind == StringType()
    names = ["id", "start", "end", "like_id", "like_start", "like_end", "joined"]

    def compare(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        ids, near = (texts.column(c).to_numpy() for c in ("id", "near"))
        _, row = np.unique(ids, return_index=True)  # rows of a table may repeat
        texts = texts.take(row[np.argsort(near[row], kind="stable")])
        ids = texts.column("id").to_numpy()
        rising = np.argsort(ids)
        ends = [pairs.column(c).to_numpy() for c in "ab"]
        there = np.logical_and(*(is_among(c, ids[rising]) for c in ends))
        a, b = (rising[np.searchsorted(ids[rising], c[there])] for c in ends)
        data, offsets = text_buffer(texts.column("x"))
        cut = offsets // 4
        code, _ = pd.factorize(data.view(np.uint32))  # in the order in which they first come, so near texts' are near
        found = shared_spans(code, cut, a, b, least - SHINGLE + 1)
        text, start, end, other, like_start, like_end = np.concatenate([found, found[[3, 4, 5, 0, 1, 2]]], axis=1)
        by = other
        if ordered:
            by = pc.rank(texts.column("like_id").combine_chunks(), null_placement="at_start", tiebreaker="dense")
            by = by.to_numpy().astype(np.int64)[other]
        order = np.lexsort((like_end, like_start, by, end, start, text))
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        text, start, end, other, like_start, like_end = (
            c[order] for c in (text, start, end, other, like_start, like_end)
        )
        least_of = np.ones(len(order), bool)
        least_of[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        step = int(end.max(initial=0)) + 1  # spans of a text before are below those of a text
        before = np.append(-1, np.maximum.accumulate(end + text * step)[:-1])[: len(order)]
        new = start + text * step > before - least
        place, first = np.cumsum(new) - 1, np.flatnonzero(new)
        root = first[roots(len(first), *place[at].reshape(2, -1))]
        joined = mix(ids[text[root]].view(np.uint64) ^ mix(((start[root] << 32) + end[root]).view(np.uint64)))
        marked = np.zeros(len(order), np.int64)
        marked[first] = joined.view(np.int64)
        keep = np.flatnonzero(least_of) if ordered else np.arange(len(order))
        other = texts.column("like_id").take(pa.array(other[keep]))
        columns = [
            pa.array(ids[text[keep]]), *(pa.array(c[keep].astype(np.int32)) for c in (start, end)), other,
            *(pa.array(c[keep].astype(np.int32)) for c in (like_start, like_end)),
            pa.array(marked[keep], mask=~new[keep]),
        ]
        return pa.table(columns, names)

    dealt = dealt_pairs(pairs, reps.select("id", "n"))
    both = dealt.select("shard", "near", F.col("a").alias("id")).union(dealt.select("shard", "near", "b"))
    sent = both.groupBy(F.col("shard").alias("to"), "id").agg(F.min("near").alias("near"))
    sent = sent.join(reps.select("id", "rep"), "id").withColumnRenamed("id", "of")
    sent = sent.join(texts, (F.col("of") == F.col("id")) & F.col("rep").eqNullSafe(F.col("like_id")))
    sent = sent.select("to", "id", "near", "like_id", "x")
    schema = StructType(
        [
            StructField("id", LongType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
            StructField("like_id", kind), StructField("like_start", IntegerType()),
            StructField("like_end", IntegerType()), StructField("joined", LongType()),
        ]
    )
    return sent.groupBy("to").cogroup(dealt.groupBy("shard")).applyInArrow(compare, schema)


def placed(spans: DataFrame, least: int) -> DataFrame:
    """``spans`` with their ``place`` in the text, a 64-bit hash, and ``low``, where it begins.

    Spans of a text that overlap by ``least`` words or more are one place: what they share is a passage of
    its own.
    """
    order = Window.partitionBy("id").orderBy("start", "end")  # no more of a text than fit into it
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = before.isNull() | (F.col("start") > before - least)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low = F.max(F.when(F.col("new"), F.col("start"))).over(upto)
    spans = spans.withColumn("new", new).withColumn("low", low).drop("new")
    return spans.withColumn("place", F.xxhash64("id", "low"))


def passages(places: DataFrame) -> DataFrame:
    """The ``passage`` of each ``place``: what verified links between places lead to, named by a 64-bit hash.

    ``places`` has lists of what ``verified_spans`` calls ``joined``.
    """
    links = saved(places.select("place", F.explode("joined").alias("joined")).distinct(), "passage_joined")
    to = links.groupBy("joined").agg(F.min("place").alias("to"))
    labels = components(links.join(to, "joined").select("place", "to"), "place", "to")
    return labels.select(F.col("vertex").alias("place"), F.col("label").alias("passage"))


def repeated_passages(
    docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Passages of at least ``least`` words that another document has too, or nearly.

    One row per document and passage: the id, ``start`` and ``end`` (words; the end is behind the last),
    ``like_id``, ``like_start``, ``like_end`` (a document that has it and where), ``whole`` (the two texts
    have the same words; then the whole text is the passage) and ``passage``. Of a passage in many
    documents each one names one other; all that verified links lead to, whichever are named, have the
    same ``passage``, where spans of a text that overlap by ``least`` words or more count as one.

    Found by min-hash: a passage without changes always, one with few changes nearly always, in however many
    texts its sentences are. A text that is null or has fewer words has none. Repeated rows count as documents; of equal texts each names
    the smallest id, which names the next. Null ids come as null. No rows give no rows.
    """
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = words(part.column("text"))
                x, doc, _ = shingles(found, SHINGLE)
                x = (x >> np.uint64(32)).astype(np.uint32)
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                rows = [x[p:q].tobytes() for p, q in zip(cut[:-1], cut[1:], strict=True)]
                ids = np.frombuffer(b"".join(t[:8] for t in text_ids(found)), np.int64)
                columns = [part.column("_id"), pa.array(ids), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["like_id", "id", "x"])

    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    shards = max(SHARDS, -(-size // SHARD_BYTES))
    spark = docs.sparkSession
    members_at, met_at = (scratch_path(spark, name) for name in ("passage_members", "passage_met"))
    with scratch_scope(spark):  # signatures are removed once they have met
        found = saved(texts_and_blocks(named, shards, least), "passage_texts")
        members = saved_at(found.where("key IS NOT NULL").select("_id", "key", "id", "n"), members_at)
        met = saved_at(candidate_pairs(found), met_at)
    classes = saved(
        members.groupBy("key", "id", "n").agg(
            F.min("_id").alias("rep"), F.max("_id").alias("last"), F.count("*").alias("copies")
        ),
        "passage_classes",
    )
    pairs = saved(met.where("place < 0").select("a", "b").distinct(), "passage_pairs")
    involved = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    reps = classes.groupBy("id").agg(F.min("rep").alias("rep"), F.max("n").alias("n")).join(involved, "id")
    reps = saved(reps, "passage_reps")
    kept = StructType([StructField("like_id", named.schema["_id"].dataType)]).add("id", "long").add("x", "binary")
    bodies = saved(among(named, "_id", reps, "rep", sequences, kept), "passage_bodies")
    spans = saved(verified_spans(pairs, bodies, reps, least), "passage_spans")
    places = placed(spans, least).groupBy("id", "low", "place").agg(
        F.max("end").alias("high"), F.collect_set("joined").alias("joined")
    )
    places = saved(places, "passage_places")
    known = places.select("id", "low", "high", "place").join(passages(places), "place")
    groups = met.where("place >= 0").select(F.col("a").alias("id"), F.col("b").alias("key"), "place")
    rest = remaining_pairs(groups, known.drop("place"), bodies, least)
    rest = saved(rest.join(pairs, ["a", "b"], "left_anti"), "passage_rest")
    ends = rest.select(F.col("a").alias("id")).union(rest.select("b")).distinct()
    some = among(bodies, "id", ends, "id")
    spans = spans.union(saved(verified_spans(rest, some, reps, least), "passage_rest_spans"))
    one = placed(spans, least).groupBy("id", "start", "end").agg(
        F.min(F.struct("like_id", "like_start", "like_end")).alias("like"),
        F.max("place").alias("place"), F.collect_set("joined").alias("joined"),
    )
    one = saved(one, "passage_ends")
    one = one.select("id", "start", "end", "like.*", F.lit(False).alias("whole"), "place").join(
        passages(one), "place"
    )
    one = one.drop("place")
    found = members.select("_id", "id").join(one, "id").drop("id")
    copies = classes.where("copies > 1").select("key", "rep", "last")
    other = F.when(F.col("_id").eqNullSafe(F.col("rep")), F.col("last")).otherwise(F.col("rep"))
    equal = members.join(copies, "key").select(
        "_id", F.lit(0).alias("start"), F.col("n").alias("end"), other.alias("like_id"),
        F.lit(0).alias("like_start"), F.col("n").alias("like_end"), F.lit(True).alias("whole"),
        F.xxhash64("key").alias("passage"),
    )
    return found.unionByName(equal).withColumnRenamed("_id", id_col)
