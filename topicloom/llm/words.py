"""Words and shingles of whole Arrow columns of text as numpy arrays.

A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``; upper-case A-Z counts as lower
case, all other bytes as they are. Words and shingles are 64-bit hashes of those bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xBF58476D1CE4E5B9)
_K3 = np.uint64(0x94D049BB133111EB)
_LONG = 512  # bytes; longer words are hashed one at a time

_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


class Words(NamedTuple):
    """``doc[i]`` is the row of word i, ``start`` and ``end`` its bytes, ``hash`` its hash."""

    docs: int
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def first(self) -> np.ndarray:
        """Position of each row's first word, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(self.docs + 1))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of text; nulls are empty."""
    texts = pa.chunked_array([texts]) if isinstance(texts, pa.Array) else texts
    texts = texts.cast(pa.large_binary()).fill_null(b"").combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or len(at) == 0 or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text, one row at least."""
    sizes = np.array(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    group = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(int(a), int(b - a))


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ranges of bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = end - start
    out = mix(size.astype(np.uint64) * _K1)
    for i in np.flatnonzero(size > _LONG):
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    todo = np.flatnonzero(size <= _LONG)
    at, left = start[todo], size[todo]
    while len(todo):
        lane = lanes[at] & _MASKS[np.minimum(left, 8)]
        out[todo] = mix((out[todo] ^ lane) * _K1 + _K3)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return out


def words(texts: pa.Array, lower: bool = True) -> Words:
    """All words of a column of text; ``lower=False`` tells upper and lower case apart."""
    data, offsets = text_buffer(texts)
    docs = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(docs, none, none, none, np.zeros(0, np.uint64))
    inside = _IN_WORD[data]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(docs, doc, start, end, hash_ranges(_LOWER[data] if lower else data, start, end))


def fold(hashes: np.ndarray) -> np.uint64:
    """One hash of a short sequence of word hashes, as ``shingles`` combines them."""
    x = hashes[:1].copy()
    for h in hashes[1:]:
        x = mix(x * _K1 + h)
    return x[0]


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``size`` neighbouring words, their rows, and the position of their first word."""
    n = len(found.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = found.hash[:n].copy()
    for k in range(1, size):
        x = mix(x * _K1 + found.hash[k : n + k])
    at = np.flatnonzero(found.doc[:n] == found.doc[size - 1 :])
    return x[at], found.doc[at], at


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct numbers of an array."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; of a shorter text, its whole sequence as one."""
    found = words(texts)
    x, doc, _ = shingles(found, size)
    cut = np.searchsorted(doc, np.arange(found.docs + 1))
    out = [distinct(x[cut[i] : cut[i + 1]]) for i in range(found.docs)]
    first = found.first()
    for i in np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size)):
        out[i] = np.array([fold(found.hash[first[i] : first[i + 1]])], dtype=np.uint64)
    return out
