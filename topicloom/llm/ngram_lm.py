"""A smoothed n-gram language model in Elias-Fano tries, counted and queried in shards.

Words are counted over all training texts. The most frequent ones, at most ``KNOWN`` by a power of two
as least count, get a number each; that list has a fixed bound and is sent to all tasks. Pairs of
neighbouring numbers are counted in shards by a hash of the pair, so a frequent context is
spread over all of them, and each shard is a trie of its pairs with quantised probabilities:

    p(w | v) = max(c(vw) - D, 0) / c(v) + D * T(v) / c(v) * p(w)

with T(v) the different words seen behind v, D = n1 / (n1 + 2 n2) from the numbers of pairs seen once and
twice, and p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). An unseen pair has the second term alone, which needs
no trie. The probabilities behind a context sum to one.

All other words are rare, and no task knows them all. Pairs with a rare word are counted by the hashes of both, in the
shard of the rare one (the first, if both are), which none is frequent enough to fill. As

    log p(w | v) = log(D T(v) / c(v)) + log p(w) + log(1 + (c(vw) - D) / (D T(v) p(w)))

for a seen pair, and without the last term for an unseen one, each term is held where it is known: the first
in the shard of v, the second in that of w, and the last, whose count goes on to the shard of w, by a
hash of the pair. So every pair has its own probability, however many words there are; the list saves time only.

Tasks send what they count or ask as compressed blocks of sorted numbers, one per shard and some
megabytes of text, and get back one number per document and shard. Nothing is collected but sums, the
bounded list and a counter per listed word.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from topicloom.llm import counters
from topicloom.llm.blocks import pack, unpack
from topicloom.llm.elias_fano import Trie
from topicloom.llm.words import Words, mix, slices, words
from topicloom.session import saved

KNOWN = 1 << 18  # words with a number of their own, at most
SHARDS = 32  # at least
SHARD_TOKENS = 40_000_000  # training tokens per shard beyond that
SLICE = 8 << 20  # bytes of text in a block
BITS = np.uint64(20)  # of a number in a pair
RARE, START, END = KNOWN, KNOWN + 1, KNOWN + 2
NUMBERS = KNOWN + counters.CHUNKS  # with the three above, rounded up


def counted(x: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers and how often (or with what weight) they come."""
    if weight is None:
        return np.unique(x, return_counts=True)
    order = np.argsort(x, kind="stable")
    x, weight = x[order], weight[order]
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    return x[first], np.add.reduceat(weight, first) if len(x) else weight


def _merged(keys, counts) -> tuple[np.ndarray, np.ndarray]:
    keys = [unpack(k, True) for k in keys]
    return counted(np.concatenate(keys), np.concatenate([unpack(c) for c in counts]))


def found_at(rising: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of ``x`` is among some sorted numbers, and at which place."""
    if not len(rising):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(rising, x), len(rising) - 1)
    return rising[at] == x, at


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
    )


BLOCK = "shard int, keys binary, counts binary"


def _blocks(keys: np.ndarray, counts: np.ndarray, shards: int) -> pa.RecordBatch:
    """Sorted keys and counts as a block per shard."""
    shard = shard_of(keys, shards)
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = []
    for s in range(shards):
        own = order[cut[s] : cut[s + 1]]
        if len(own):
            rows.append((s, pack(keys[own], True), pack(counts[own])))
    return _batch(rows or [(0, pack([], True), pack([]))], BLOCK)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys) % np.uint64(shards)).astype(np.int64)


class Vocabulary(NamedTuple):
    """What every task knows of the training words."""

    tokens: int  # N, with an end for each text
    types: int  # V, with the end
    texts: int
    hashes: np.ndarray  # of the listed words, sorted
    numbers: np.ndarray  # their numbers, by falling count
    counts: np.ndarray  # by number; with those of starts and of ends

    def probability(self, count: np.ndarray | float) -> np.ndarray | float:
        return (count + 0.5) / (self.tokens + 0.5 * (self.types + 1))

    def logs(self) -> np.ndarray:
        """log10 p(w) by number."""
        return np.log10(self.probability(self.counts.astype(np.float64)))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), RARE)
        there, at = found_at(self.hashes, hashes)
        return np.where(there, self.numbers[at], RARE)


class Model(NamedTuple):
    """``table``: shards of tries, and behind them of rare words with their counts, followers and pairs' last terms."""

    vocabulary: Vocabulary
    shards: int
    table: DataFrame
    discount: float
    spread: np.ndarray  # log10 of D T(v) / c(v) by number; 0 for a context never seen


class Pairs(NamedTuple):
    """The words of some texts and their pairs: ``keys`` of two numbers, and those with a rare word."""

    found: Words
    number: np.ndarray  # of each word
    keys: np.ndarray
    doc: np.ndarray
    v: np.ndarray  # numbers of the pairs with a rare word
    w: np.ndarray
    v_name: np.ndarray  # their numbers, or hashes if rare
    w_name: np.ndarray
    rare_doc: np.ndarray


def _pairs(texts: pa.Array, known: Vocabulary) -> Pairs:
    """Words of texts with their numbers, and pairs with the text they are in."""
    found = words(texts)
    number = known.number(found.hash)
    first = found.first()
    sizes = np.diff(first)
    # every text: start, words, end
    place = np.arange(len(number)) + found.doc * 2 + 1
    row = np.full(len(number) + 2 * found.docs, END, np.int64)
    row[place] = number
    row[first[:-1] + 2 * np.arange(found.docs)] = START
    doc = np.repeat(np.arange(found.docs), sizes + 2)[1:]
    inside = row[:-1] != END
    rare = inside & ((row[:-1] == RARE) | (row[1:] == RARE))
    inside &= ~rare
    keys = (row[:-1].astype(np.uint64) << BITS | row[1:].astype(np.uint64))[inside]
    at = np.flatnonzero(rare)
    name = row.astype(np.uint64) if len(at) else np.zeros(0, np.uint64)
    if len(at):
        name[place] = np.where(number == RARE, found.hash, name[place])
    return Pairs(found, number, keys, doc[inside], row[at], row[at + 1], name[at], name[at + 1], doc[at])


RARE_BLOCK = BLOCK + ", v binary, w binary"
TERMS = "shard int, kind string, keys binary, value binary, w binary, followed binary"


class RarePairs:
    """Distinct pairs of names and how often they come."""

    def __init__(self):
        self.v, self.w, self.times = (np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64))

    def add(self, v: np.ndarray, w: np.ndarray, times: np.ndarray) -> None:
        v, w, times = np.append(self.v, v), np.append(self.w, w), np.append(self.times, times)
        order = np.lexsort((w, v))
        v, w, times = v[order], w[order], times[order]
        first = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (w[1:] != w[:-1]))) if len(v) else []
        self.v, self.w = v[first], w[first]
        self.times = np.add.reduceat(times, first) if len(v) else times

    def blocks(self, shards: int) -> Iterator[pa.RecordBatch]:
        """A block per shard of the rare word, the first if both are; its number is -1 less the shard."""
        one = np.where(is_rare(self.v), self.v, self.w)
        for shard, own in _by_shard(shard_of(one, shards), shards):
            line = (-1 - shard, None, pack(self.times[own]), pack(self.v[own], True), pack(self.w[own]))
            yield _batch([line], RARE_BLOCK)


def is_rare(names: np.ndarray) -> np.ndarray:
    """Which names are hashes; a hash is no more likely to be that small than to be another's."""
    return names >= np.uint64(NUMBERS)


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(v) * np.uint64(3) + w)


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that comes and the places where it does, rising."""
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if cut[s + 1] > cut[s]:
            yield s, order[cut[s] : cut[s + 1]]


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of all texts of ``docs``; a null text is empty, which is one end token."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("text"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                new, times = counted(words(part.column("text")).hash)
                keys, counts = counted(np.append(keys, new), np.append(counts, times))
                rows += part.num_rows
                if len(keys) > 4_000_000:
                    yield _blocks(keys, counts, SHARDS)
                    keys, counts = keys[:0], counts[:0]
        yield _blocks(keys, counts, SHARDS)
        if rows:
            yield _batch([(-1, None, pack([rows]))], BLOCK)  # the number of texts

    def merge_words(pdf):
        if pdf["shard"].iloc[0] < 0:
            rows = sum(int(unpack(c)[0]) for c in pdf["counts"])
            return pd.DataFrame([(-1, b"", b"", rows, 0, [])], columns=columns)
        keys, counts = _merged(pdf["keys"], pdf["counts"])
        steps = np.floor(np.log2(np.maximum(counts, 1).astype(np.float64))).astype(int)
        row = (
            pdf["shard"].iloc[0], pack(keys, True), pack(counts), int(counts.sum()), len(keys),
            np.bincount(steps, minlength=64).tolist(),
        )
        return pd.DataFrame([row], columns=columns)

    columns = ["shard", "keys", "counts", "tokens", "types", "steps"]
    merged = texts.mapInArrow(count_words, BLOCK).groupBy("shard").applyInPandas(
        merge_words, "shard int, keys binary, counts binary, tokens bigint, types bigint, steps array<bigint>"
    )
    merged = saved(merged, "lm_words")
    sums = merged.where("shard >= 0").agg(
        F.sum("tokens").alias("tokens"), F.sum("types").alias("types"),
        *(F.sum(F.get("steps", F.lit(k))).alias(f"s{k}") for k in range(64)),
    ).first()
    total = merged.where("shard < 0").agg(F.sum("tokens")).first()[0] or 0
    at_least = np.cumsum([sums[f"s{k}"] or 0 for k in range(63, -1, -1)])[::-1]
    step = next(k for k in range(64) if at_least[k] <= KNOWN)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(*(batch.column(c).to_pylist() for c in ("keys", "counts")), strict=True):
                keys, counts = unpack(keys, True), unpack(counts)
                on = counts >= (1 << step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[on].view(np.int64)), pa.array(counts[on].astype(np.int64))], ["h", "c"]
                )

    blocks = merged.where("shard >= 0").select("shard", "keys", "counts")
    listed = blocks.mapInArrow(frequent, "h bigint, c bigint").toPandas()  # KNOWN rows at most
    hashes = listed["h"].to_numpy(np.int64).view(np.uint64)
    counts = listed["c"].to_numpy(np.int64)
    rank = np.lexsort((hashes, -counts))
    by_number = np.zeros(NUMBERS, np.int64)
    by_number[: len(rank)] = counts[rank]
    numbers = np.empty(len(rank), np.int64)
    numbers[rank] = np.arange(len(rank))
    order = np.argsort(hashes)
    word_tokens, word_types = sums.tokens or 0, sums.types or 0
    by_number[START] = by_number[END] = total
    known = Vocabulary(
        word_tokens + total, word_types + (total > 0), total, hashes[order], numbers[order], by_number
    )
    shared = spark.sparkContext.broadcast(known)
    shards = max(SHARDS, -(-known.tokens // SHARD_TOKENS))

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, rare = np.zeros(0, np.uint64), np.zeros(0, np.int64), RarePairs()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                met = _pairs(part.column("text"), shared.value)
                new, times = counted(met.keys)
                keys, counts = counted(np.append(keys, new), np.append(counts, times))
                if len(met.v):
                    rare.add(met.v_name, met.w_name, np.ones(len(met.v), np.int64))
                if len(keys) > 4_000_000:
                    yield wide(_blocks(keys, counts, shards))
                    keys, counts = keys[:0], counts[:0]
                if len(rare.v) > 2_000_000:
                    yield from rare.blocks(shards)
                    rare = RarePairs()
        yield wide(_blocks(keys, counts, shards))
        yield from rare.blocks(shards)

    def wide(block: pa.RecordBatch) -> pa.RecordBatch:
        none = [pa.nulls(block.num_rows, pa.binary())] * 2
        return pa.RecordBatch.from_arrays([*block.columns, *none], [*block.schema.names, "v", "w"])

    def merge_pairs(pdf):
        if pdf["shard"].iloc[0] < 0:
            rare = RarePairs()
            rare.add(
                np.concatenate([unpack(v, True) for v in pdf["v"]]),
                np.concatenate([unpack(w) for w in pdf["w"]]),
                np.concatenate([unpack(c).astype(np.int64) for c in pdf["counts"]]),
            )
            keys, counts, v, w = None, rare.times, pack(rare.v, True), pack(rare.w)
        else:
            keys, counts = _merged(pdf["keys"], pdf["counts"])
            keys, v, w = pack(keys, True), None, None
        row = (pdf["shard"].iloc[0], keys, pack(counts), v, w, int((counts == 1).sum()),
               int((counts == 2).sum()))
        return pd.DataFrame([row], columns=["shard", "keys", "counts", "v", "w", "once", "twice"])

    pairs = texts.mapInArrow(count_pairs, RARE_BLOCK).groupBy("shard").applyInPandas(
        merge_pairs, RARE_BLOCK + ", once bigint, twice bigint"
    )
    pairs = saved(pairs, "lm_pairs")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(NUMBERS, np.int64)
        for batch in batches:
            for keys, v in zip(*(batch.column(c).to_pylist() for c in ("keys", "v")), strict=True):
                if keys is not None:
                    v = (unpack(keys, True) >> BITS).astype(np.int64)
                else:
                    v = unpack(v, True)
                    v = v[~is_rare(v)].astype(np.int64)
                table += np.bincount(v, minlength=NUMBERS)
        yield from counters.counter_rows(table)

    different = counters.summed(pairs.select("keys", "v").mapInArrow(contexts, counters.SCHEMA), NUMBERS)
    seen = pairs.agg(F.sum("once"), F.sum("twice")).first()
    once, twice = (v or 0 for v in seen)
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    as_context = np.where(np.arange(NUMBERS) == END, 0, known.counts).astype(np.float64)
    mass = discount * different / np.maximum(1, as_context)
    mass[different == 0] = 1.0
    side = spark.sparkContext.broadcast((mass, as_context, 10 ** known.logs(), different))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, total, alone, _ = side.value
        for batch in batches:
            for shard, keys, counts in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                keys, counts = unpack(keys, True), unpack(counts).astype(np.float64)
                grams = np.stack(split(keys), axis=1)
                v, w = grams.T
                p = (counts - discount) / total[v] + mass[v] * alone[w]
                trie = Trie.of(NUMBERS, grams, np.log10(p))
                yield _batch([(shard, trie.to_bytes())], "shard int, trie binary")

    tries = pairs.where("shard >= 0").select("shard", "keys", "counts").mapInArrow(
        build, "shard int, trie binary"
    )

    def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(*(batch.column(c).to_pylist() for c in ("keys", "counts")), strict=True):
                keys, counts = unpack(keys, True), unpack(counts)
                rare = counts < (1 << step)
                keys, counts = keys[rare], counts[rare]
                for s, own in _by_shard(shard_of(keys, shards), shards):
                    yield _batch([(s, pack(keys[own], True), pack(counts[own]))], BLOCK)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Followers of rare contexts, and pairs with those of their context, sent to where they are asked for."""
        followers = side.value[3]
        for batch in batches:
            for shard, counts, v, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                v, w, counts = unpack(v, True), unpack(w), unpack(counts)
                own, at, times = np.unique(v, return_inverse=True, return_counts=True)
                mine = is_rare(own)
                line = (-1 - shard, "context", pack(own[mine], True), pack(times[mine]), None, None)
                yield _batch([line], TERMS)
                listed = np.minimum(v, np.uint64(NUMBERS - 1)).astype(np.int64)
                followed = np.where(is_rare(v), times[at], followers[listed])
                last = is_rare(w)
                for kind, here in (("pair", np.flatnonzero(~last)), ("last", np.flatnonzero(last))):
                    # The shard of a rare w, or else of the rare v.
                    home = shard_of(w[here] if kind == "last" else v[here], shards)
                    for s, some in _by_shard(home, shards):
                        some = here[some]
                        line = (s, kind, pack(v[some], True), pack(counts[some]), pack(w[some]), pack(followed[some]))
                        yield _batch([line], TERMS)

    def settle(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """Rare words with their counts and followers, and the last terms of pairs."""
        keys, counts = _merged(held["keys"], held["counts"]) if len(held) else (np.zeros(0, np.uint64),) * 2
        followers = np.zeros(len(keys), np.int64)
        names, values = [np.zeros(0, np.uint64)], [np.zeros(0)]
        alone = side.value[2]
        columns = (asked[c] for c in ("kind", "keys", "value", "w", "followed"))
        for kind, v, times, w, followed in zip(*columns, strict=True):
            v, times = unpack(v, True), unpack(times)
            if kind == "context":
                there, at = found_at(keys, v)
                followers[at[there]] = times[there]
                continue
            w = unpack(w)
            if kind == "last":
                _, at = found_at(keys, w)
                p = shared.value.probability(counts[at].astype(np.float64))
            else:
                p = alone[w.astype(np.int64)]
            names.append(pair_keys(v, w))
            values.append(np.log10(1 + (times - discount) / (discount * unpack(followed) * p)))
        names, values = np.concatenate(names), np.concatenate(values)
        order = np.argsort(names)
        shard = shards + (held if len(held) else asked)["shard"].iloc[0]
        row = (shard, pack(keys, True), pack(counts), pack(followers), pack(names[order], True),
               pack(values[order].view(np.uint64)))
        return pd.DataFrame([row], columns=["shard", "keys", "counts", "followers", "pairs", "terms"])

    held = "shard int, keys binary, counts binary, followers binary, pairs binary, terms binary"
    own = blocks.mapInArrow(rare_words, BLOCK).groupBy("shard")
    rare = pairs.where("shard < 0").select("shard", "counts", "v", "w").mapInArrow(terms, TERMS)
    settled = rare.groupBy("shard").cogroup(own).applyInPandas(settle, held)
    table = settled.unionByName(tries, allowMissingColumns=True)
    return Model(known, shards, saved(table, "lm_model"), discount, np.log10(mass))


def split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both numbers of pairs."""
    return (keys >> BITS).astype(np.int64), (keys & np.uint64((1 << 20) - 1)).astype(np.int64)


ASK = "shard int, slice bigint, kind string, keys binary, counts binary, rows binary"
ANSWER = "slice bigint, rows binary, known binary, base binary, score binary, own binary"


def _asked(
    keys: np.ndarray, row: np.ndarray, shard: np.ndarray, shards: int, slice_: int, kind: str
) -> list[tuple]:
    """Keys and the rows they are in as a block per shard."""
    order = np.argsort(keys, kind="stable")
    keys, row = keys[order], row[order]
    out = []
    for s, own in _by_shard(shard[order], 2 * shards):
        unique, times = np.unique(keys[own], return_counts=True)
        out.append((s, slice_, kind, pack(unique, True), pack(times), pack(row[own])))
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``base_score`` is the sum of log10 p(w) over the tokens, ``score`` the model's log10 probability of
    the text; the end is a token. A null or empty text is one end. Texts are read whole; rows that
    repeat are scored each; no rows give no rows. Rows are told apart by partition and place, so
    ``docs`` should be a table that is read the same way again, or be written down before.
    """
    spark = docs.sparkSession
    known, shards, discount = model.vocabulary, model.shards, model.discount
    shared = spark.sparkContext.broadcast((known, known.logs(), model.spread))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, logs, spread = shared.value
        slice_ = TaskContext.get().partitionId() << 24
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                met = _pairs(part.column("text"), words_of)
                found, number = met.found, met.number
                listed = number != RARE
                size = np.bincount(found.doc, minlength=found.docs) + 1
                ends = words_of.texts > 0
                sure = np.bincount(found.doc[listed], minlength=found.docs) + ends
                base = np.bincount(found.doc[listed], logs[number[listed]], found.docs) + logs[END]
                # What a listed word adds to the pairs that it has with a rare one.
                beside = np.where(met.v == RARE, 0, spread[met.v]) + np.where(met.w == RARE, 0, logs[met.w])
                beside = np.bincount(met.rare_doc, beside, found.docs).astype(np.float64)  # of none: whole numbers
                own = part.select([0]).append_column("size", pa.array(size)).append_column(
                    "known", pa.array(sure)).append_column("base", pa.array(base)).append_column(
                    "beside", pa.array(beside))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema) as writer:
                    writer.write_batch(own)
                rows = _asked(met.keys, met.doc, shard_of(met.keys, shards), shards, slice_, "pair")
                if not listed.all():
                    # The shards of rare words come behind those of the tries.
                    rare, doc = found.hash[~listed], found.doc[~listed]
                    rows += _asked(rare, doc, shards + shard_of(rare, shards), shards, slice_, "word")
                    home = shards + shard_of(np.where(met.w == RARE, met.w_name, met.v_name), shards)
                    keys = pair_keys(met.v_name, met.w_name)
                    rows += _asked(keys, met.rare_doc, home, shards, slice_, "rare")
                rows.append((slice_ % shards, slice_, "own", None, None, sink.getvalue().to_pybytes()))
                yield _batch(rows, ASK)
                slice_ += 1

    def answer(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        words_of, logs, spread = shared.value
        out = []
        for kind, group in asked.groupby("kind", sort=True):
            if kind == "own":
                out += [(s, None, None, None, None, r) for s, r in zip(group["slice"], group["rows"], strict=True)]
                continue
            keys = [unpack(k, True) for k in group["keys"]]
            unique = np.unique(np.concatenate(keys))
            if kind == "word":
                count, behind = np.zeros(len(unique)), np.zeros(len(unique))
                for have, times, followers in zip(
                    held["keys"], held["counts"], held["followers"], strict=True
                ):
                    if have is not None:
                        there, at = found_at(unpack(have, True), unique)
                        count[there] = unpack(times)[at[there]]
                        behind[there] = unpack(followers)[at[there]]
                value = np.log10(words_of.probability(count))
                spent = np.log10(np.where(behind > 0, discount * behind / np.maximum(count, 1), 1.0))
            elif kind == "rare":
                value = np.zeros(len(unique))
                for have, term in zip(held["pairs"], held["terms"], strict=True):
                    if have is not None:
                        there, at = found_at(unpack(have, True), unique)
                        value[there] = unpack(term).view(np.float64)[at[there]]
            else:
                v, w = split(unique)
                value = spread[v] + logs[w]
                for blob in held["trie"]:
                    if blob is not None:
                        with mmap.mmap(-1, len(blob)) as block:
                            block.write(blob)
                            _lookup(block, v, w, value)
            for slice_, own, times, rows in zip(
                group["slice"], keys, group["counts"], group["rows"], strict=True
            ):
                at = np.repeat(np.searchsorted(unique, own), unpack(times).astype(np.int64))
                rows = unpack(rows).astype(np.int64)
                total = np.bincount(rows, value[at])
                there = np.unique(rows)
                line = [slice_, pack(there, True), None, None, None, None]
                if kind == "word":
                    line[2] = pack(np.bincount(rows, count[at] > 0)[there])
                    line[3] = total[there].tobytes()
                    total += np.bincount(rows, spent[at])
                line[4] = total[there].tobytes()
                out.append(tuple(line))
        return pd.DataFrame(out, columns=[c.split()[0] for c in ANSWER.split(", ")])

    kind = docs.schema[id_col].dataType
    schema = StructType(
        [StructField(id_col, kind)]
        + StructType.fromDDL(
            "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
        ).fields
    )

    def gather(pdf):
        (own,) = pdf["own"].dropna()
        own = pa.ipc.open_stream(own).read_all()
        sure = own.column("known").to_numpy().copy()
        base = own.column("base").to_numpy().copy()
        total = own.column("beside").to_numpy().copy()
        for rows, k, b, s in zip(pdf["rows"], pdf["known"], pdf["base"], pdf["score"], strict=True):
            if rows is None:
                continue
            rows = unpack(rows, True).astype(np.int64)
            total[rows] += np.frombuffer(s)
            if k is not None:
                sure[rows] += unpack(k).astype(np.int64)
                base[rows] += np.frombuffer(b)
        table = own.select([0]).append_column("n_tokens", own.column("size"))
        table = table.append_column("n_known", pa.array(sure.astype(np.int64)))
        table = table.append_column("train_tokens", pa.array(np.full(len(base), known.tokens)))
        table = table.append_column("base_score", pa.array(base)).append_column("score", pa.array(total))
        return table.to_pandas()

    named = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    asked = named.mapInArrow(ask, ASK).groupBy("shard")
    parts = asked.cogroup(model.table.groupBy("shard")).applyInPandas(answer, ANSWER)
    return parts.groupBy("slice").applyInPandas(gather, schema)


def _lookup(block, v: np.ndarray, w: np.ndarray, value: np.ndarray) -> None:
    """Replace the values of pairs that a trie has; what is read from the block is let go again."""
    trie = Trie.open(block)
    place = trie.find(np.stack([v, w], axis=1))
    hit = place >= 0
    value[hit] = trie.value(place[hit])
    del trie
