"""Elias-Fano sequences, and a trie of n-grams whose levels are made of them.

All parts are numpy views of one buffer, so a trie can be opened on a memory-mapped file or block
without reading it. Queries take arrays.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np

_SELECT = np.full((256, 8), 8, dtype=np.int64)  # place of a byte's k-th one
for _b in range(256):
    _ones = [k for k in range(8) if _b >> k & 1]
    _SELECT[_b, : len(_ones)] = _ones


class EliasFano(NamedTuple):
    """A non-decreasing sequence: low bits side by side, high bits in unary."""

    size: int
    low_bits: int
    low: np.ndarray  # 64-bit words
    high: np.ndarray  # 64-bit words
    ones: np.ndarray  # ones before each word of ``high``

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        size, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(1, size)).bit_length() - 1)
        low = np.zeros(size * bits // 64 + 2, np.uint64)
        if bits:
            part = values & np.uint64((1 << bits) - 1)
            at = np.arange(size, dtype=np.uint64) * np.uint64(bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(size)
        flags = np.zeros(-(-(size + (top >> bits) + 2) // 64) * 64, np.uint8)
        flags[places] = 1
        high = np.packbits(flags, bitorder="little").view("<u8")
        ones = np.append(0, np.cumsum(np.bitwise_count(high), dtype=np.int64))
        return cls(size, bits, low, high, ones)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.low[word] >> shift
        rest = np.where(
            shift > 0, self.low[word + 1] << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0)
        )
        return (value | rest) & np.uint64((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th one or zero of the high bits."""
        before = self.ones if one else 64 * np.arange(len(self.ones)) - self.ones
        word = np.searchsorted(before, k, "right") - 1
        bits = self.high[word] if one else ~self.high[word]
        left = (k - before[word]).astype(np.uint64)
        place = np.zeros(len(k), np.uint64)
        for half in (32, 16, 8):
            here = np.bitwise_count((bits >> place) & np.uint64((1 << half) - 1)).astype(np.uint64)
            behind = left >= here
            left -= here * behind
            place += np.uint64(half) * behind
        last = ((bits >> place) & np.uint64(255)).astype(np.int64)
        return word * 64 + place.astype(np.int64) + _SELECT[last, left.astype(np.int64)]

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions below the size."""
        high = (self._select(i, True) - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Position of the first value that is at least x; the size if there is none."""
        x = np.asarray(x, dtype=np.uint64)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        last = len(self.high) * 64 - self.size  # zeros
        beyond = high >= last
        high = np.where(beyond, 0, high)
        start = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) - (high - 1), 0)
        end = self._select(high, False) - high
        start = np.where(beyond, self.size, np.minimum(start, self.size))
        end = np.where(beyond, self.size, end)
        low = x & np.uint64((1 << self.low_bits) - 1)
        while True:
            todo = np.flatnonzero(start < end)
            if not len(todo):
                return start
            middle = (start[todo] + end[todo]) // 2
            less = self._low(middle) < low[todo]
            start[todo] = np.where(less, middle + 1, start[todo])
            end[todo] = np.where(less, end[todo], middle)

    def parts(self) -> list[np.ndarray]:
        head = np.array([self.size, self.low_bits, len(self.low), len(self.high)], np.int64)
        return [head, self.low, self.high, self.ones]

    @classmethod
    def read(cls, buffer, at: int) -> tuple[EliasFano, int]:
        size, bits, words, high = (int(v) for v in np.frombuffer(buffer, np.int64, 4, at))
        at += 32
        low = np.frombuffer(buffer, np.uint64, words, at)
        at += words * 8
        unary = np.frombuffer(buffer, np.uint64, high, at)
        at += high * 8
        ones = np.frombuffer(buffer, np.int64, high + 1, at)
        return cls(size, bits, low, unary, ones), at + len(ones) * 8


class Level(NamedTuple):
    """One length of n-grams: pointers of the contexts to their children, and these by context."""

    pointers: EliasFano
    children: EliasFano


class Trie:
    """N-grams of one order with a quantised number each.

    Level k holds the distinct beginnings of k + 1 words. The children of a context lie between two
    pointers; as their words start again with each context, a child is stored as its word plus the
    context's place times the number of words, which never falls. A word is looked for by a successor
    search for that sum within its context.
    """

    def __init__(self, words: int, levels: list[Level], codes: np.ndarray, book: np.ndarray):
        self.words, self.levels, self.codes, self.book = words, levels, codes, book

    @classmethod
    def of(cls, words: int, grams: np.ndarray, values: np.ndarray) -> Trie:
        """From sorted distinct n-grams (a row each) and their values; values become one of 256."""
        levels, parent = [], np.zeros(len(grams), np.int64)
        for k in range(grams.shape[1]):
            key = parent.astype(np.uint64) * np.uint64(words) + grams[:, k].astype(np.uint64)
            new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
            contexts = int(parent[-1]) + 1 if len(parent) else 0
            counts = np.bincount(parent[new], minlength=contexts)
            levels.append(
                Level(EliasFano.of(np.append(0, np.cumsum(counts))), EliasFano.of(key[new]))
            )
            parent = np.cumsum(new) - 1
        book = np.quantile(values, np.linspace(0, 1, 256)) if len(values) else np.zeros(256)
        book = book.astype(np.float32)
        middles = (book[1:] + book[:-1]) / 2
        return cls(words, levels, np.searchsorted(middles, values).astype(np.uint8), book)

    def find(self, grams: np.ndarray, depth: int | None = None) -> np.ndarray:
        """Place of each n-gram, or of its first ``depth`` words; -1 if it is not there."""
        depth = len(self.levels) if depth is None else depth
        if not depth:
            return np.zeros(len(grams), np.int64)
        level, out = self.levels[depth - 1], np.full(len(grams), -1)
        if not level.children.size or not len(grams):
            return out
        # Neighbours with the same context look it up once.
        new = np.append(True, (grams[1:, : depth - 1] != grams[:-1, : depth - 1]).any(axis=1))
        context = self.find(grams[new], depth - 1)[np.cumsum(new) - 1]
        alive = np.flatnonzero(context >= 0)
        context = context[alive]
        end = level.pointers.get(context + 1).astype(np.int64)
        want = context.astype(np.uint64) * np.uint64(self.words)
        want += grams[alive, depth - 1].astype(np.uint64)
        at = level.children.successor(want)
        hit = np.flatnonzero(at < end)
        hit = hit[level.children.get(at[hit]) == want[hit]]
        out[alive[hit]] = at[hit]
        return out

    def value(self, place: np.ndarray) -> np.ndarray:
        return self.book[self.codes[place]]

    def to_bytes(self) -> bytes:
        parts = [np.frombuffer(struct.pack("<qqq", self.words, len(self.levels), len(self.codes)), np.uint8)]
        for level in self.levels:
            parts += level.pointers.parts() + level.children.parts()
        return b"".join(p.tobytes() for p in [*parts, self.book, self.codes])

    @classmethod
    def open(cls, buffer) -> Trie:
        """A trie on bytes, a memory map or anything else with a buffer."""
        words, depth, count = struct.unpack_from("<qqq", buffer, 0)
        at, levels = 24, []
        for _ in range(depth):
            pointers, at = EliasFano.read(buffer, at)
            children, at = EliasFano.read(buffer, at)
            levels.append(Level(pointers, children))
        book = np.frombuffer(buffer, np.float32, 256, at)
        return cls(words, levels, np.frombuffer(buffer, np.uint8, count, at + 1024), book)
