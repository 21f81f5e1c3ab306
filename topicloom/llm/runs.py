"""Periodic runs of words: seeds on diagonals, extended as far as the period holds.

A run is a stretch of words that are the same ``period`` words apart, at least ``times`` periods long,
which no neighbouring word extends. Two copies of it, shifted by the period, overlap in at least
(times - 1) * period words. So periods are sought in classes from 2**j up to below 2**(j + 1): the text's
k-grams of k = (times - 1) * 2**j words, the least overlap of the class, are indexed, and each
occurrence is paired with the next one in the same document. As k is no less than the period, a pair within
a run is one smallest period apart, and the run's first k-gram always gives such a pair.

A pair lies on the diagonal of its lag. Along it the stretch of equal words is extended to both sides;
a table with the furthest place covered on each lag drops the other pairs of the same stretch. Texts in which
no k-gram repeats are done; only the others are indexed for the next class.

Each text is looked at on its own, by numpy in the task that reads it; nothing is shuffled. A text of n words
takes n * log(n) steps and about 100 bytes a word. Words are compared by 64-bit hashes: in a text of n different
words the chance that two are taken for one is about n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from topicloom.llm.words import Words, mix, slices, text_buffer, words

_K = np.uint64(0x9E3779B97F4A7C15)
FIRST = 64  # words compared at once at the start of an extension

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring grams taken together."""
    return mix(left * _K + right)


def next_occurrences(grams: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of grams, and for each the place where the same gram comes next in its document."""
    key = _joined(grams, doc.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    a, b = order[:-1], order[1:]
    same = (key[a] == key[b]) & (doc[a] == doc[b])
    return a[same], b[same]


def _forward(x: np.ndarray, at: int, lag: int, end: int) -> int:
    """The first place from ``at`` on whose word is not the one ``lag`` further on, before ``end``."""
    step = FIRST
    while at + lag < end:
        size = min(step, end - lag - at)
        differ = x[at : at + size] != x[at + lag : at + lag + size]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + size, 2 * step
    return at


def _backward(x: np.ndarray, at: int, lag: int, start: int) -> int:
    """The first place of the stretch before ``at`` whose words are those ``lag`` further on."""
    step = FIRST
    while at > start:
        size = min(step, at - start)
        differ = x[at - size : at] != x[at - size + lag : at + lag]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = at - size, 2 * step
    return at


def find_runs(found: Words, times: int = 4, least: int = 6) -> np.ndarray:
    """All runs of at least ``least`` words and ``times`` periods (3 or more): row, start, length, period.

    Starts count words from 0 in each row; rows of the result are in the order of row, start, period.
    """
    first = found.first()
    x, doc = found.hash, found.doc  # of the texts still looked at
    start_of, end_of = first[:-1], first[1:]
    origin = np.arange(found.docs)
    out: list[tuple[int, int, int, int]] = []
    low, grams, k = 1, x.copy(), 1
    while k < times - 1:
        grams = _joined(grams[: len(x) - k], x[k:]) if len(x) > k else x[:0]
        k += 1
    while len(grams):
        inside = np.flatnonzero(np.arange(len(grams)) + k <= end_of[doc[: len(grams)]])
        a, b = next_occurrences(grams[inside], doc[inside])
        a, b = inside[a], inside[b]
        lag = b - a
        near = np.flatnonzero((lag >= low) & (lag < 2 * low))
        near = near[np.lexsort((a[near], lag[near]))]
        p, q = a[near], lag[near]
        new = np.append(True, (q[1:] != q[:-1]) | (p[1:] - p[:-1] > k))[: len(p)]
        covered: dict[int, int] = {}
        for at, period in zip(p[new].tolist(), q[new].tolist(), strict=True):
            if at < covered.get(period, 0):
                continue
            row = doc[at]
            begin = _backward(x, at, period, start_of[row])
            covered[period] = stop = _forward(x, at, period, end_of[row])
            length = stop + period - begin
            if length >= max(least, times * period):
                out.append((origin[row], begin - start_of[row], length, period))
        # Texts with a gram that repeats, and long enough for the next class.
        keep = np.zeros(len(start_of), bool)
        keep[doc[a]] = True
        keep &= end_of - start_of >= 2 * low * times
        kept = keep[doc]
        # Grams of twice the length; at a text's end they reach into the next one and are not looked at.
        longer = _joined(grams[: max(0, len(grams) - k)], grams[k:])
        padded = np.zeros(len(x), np.uint64)
        padded[: len(longer)] = longer
        number = np.cumsum(keep) - 1
        x, grams, doc = x[kept], padded[kept], number[doc[kept]]
        origin, size = origin[keep], (end_of - start_of)[keep]
        end_of = np.cumsum(size)
        start_of = end_of - size
        low, k = 2 * low, 2 * k
    rows = np.array(out, dtype=np.int64).reshape(-1, 4)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def collapsed_texts(texts: pa.Array, found: Words, runs: np.ndarray) -> pa.Array:
    """The texts without the words that follow the first period of a run, one space between words."""
    data, offsets = text_buffer(texts)
    first, count = found.first(), len(found.doc)
    edge = np.zeros(count + 1, np.int64)
    begin = first[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, begin + runs[:, 3], 1)
    np.add.at(edge, begin + runs[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    start, end, doc = found.start[kept], found.end[kept], found.doc[kept]
    inner = np.append(False, doc[1:] == doc[:-1])[: len(kept)]  # not the first of its text
    inside = np.zeros(len(data) + 1, np.int8)
    space = start[inner] - 1
    np.add.at(inside, np.where(inner, start - 1, start), 1)
    np.add.at(inside, end, -1)
    mask = np.cumsum(inside[:-1], dtype=np.int8) > 0
    out = data.copy()
    out[space] = 0x20
    sizes = np.append(0, np.cumsum(mask, dtype=np.int64))[offsets]
    buffers = [None, pa.py_buffer(sizes.astype(np.int32)), pa.py_buffer(out[mask].tobytes())]
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, buffers)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 4, least: int = 6
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, its ``runs`` and the ``collapsed`` text.

    Words are ``[^\\x20\\x09-\\x0D]+``, told apart by case and numbered from 0. ``runs`` are all stretches of at
    least ``least`` words and ``times`` periods, with ``start``, ``length`` and smallest ``period``, in the order of
    start and period. ``collapsed`` has the words that no run contains after its first period, joined by
    one space. Ids may be null or repeat: each row is looked at alone. A text that is null, empty or
    without words has no runs and an empty ``collapsed``. Texts are read whole. No rows give no rows. Other
    columns are not looked at.
    """
    if times < 3:
        raise ValueError("a run must have 3 periods or more")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                found = words(texts, lower=False)
                runs = find_runs(found, times, least)
                ends = np.searchsorted(runs[:, 0], np.arange(found.docs + 1)).astype(np.int32)
                fields = [pa.array(runs[:, c]) for c in (1, 2, 3)]
                items = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"), pa.array(np.diff(found.first()).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), items),
                        collapsed_texts(texts, found, runs),
                    ],
                    ["_id", "n_words", "runs", "collapsed"],
                )

    named = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    schema = StructType(
        [named.schema["_id"]]
        + StructType.fromDDL(f"n_words bigint, runs array<{RUN}>, collapsed string").fields
    )
    return named.mapInArrow(emit, schema).withColumnRenamed("_id", id_col)
