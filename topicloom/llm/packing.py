"""Harmonic packing of documents into sequences of a fixed number of tokens.

A piece longer than capacity / (j + 1) and at most capacity / j is of class j, and a bin of class j
takes j such pieces. Documents are cut so that pieces come close to the upper end of a class: first
into whole sequences, then at the largest capacity / j that the rest still holds, until the rest
itself is close to such an end or short. Each worker fills the bins of its own partition. Where it
ends, the pieces of its unfilled bins are laid end to end, cut at the capacity, and the very last
sequence is cut at powers of two.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from topicloom.llm.words import hash_ranges, slices, text_buffer

#: Tokens of a column of texts, one after the other, and where each text's begin.
Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

SLICE = 2 << 20  # bytes of text encoded at once
CACHE = 400_000  # parts of text whose tokens a worker remembers

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
# White space beyond ASCII; a text that has any is encoded as a whole.
_WIDE_SPACE = "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> Encoder:
    """The tokens of texts by a byte-level BPE file of ``tokenizers``.

    Such a tokenizer first cuts a text by a pattern, and most of what a slice of texts is cut into
    repeats. So texts are cut at places where the pattern surely ends a match, the distinct parts (by
    64-bit hash) are encoded once, and the tokens put together again. The encoder and what it
    remembers are kept for the worker's next task.
    """
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    byte_of = {c: b for b, c in _byte_characters().items()}
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in made["model"]["vocab"].items()
        if all(c in byte_of for c in token)
    }
    for token in made["added_tokens"]:
        ranks.pop(token["content"].encode(), None)
    # Fixed value: the pattern that goes with the file.
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    whole = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    known: dict[int, int] = {}
    flat, ends = array("I"), array("q", [0])

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_buffer(texts)
        wide = pc.match_substring_regex(texts.cast(pa.large_string()), _WIDE_SPACE)
        wide = np.asarray(wide.fill_null(False))
        start = _cuts(data, offsets, wide)
        end = np.append(start[1:], len(data)).astype(np.int64)
        hashes = hash_ranges(data, start, end)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(known) + len(unique) > CACHE and known:
            known.clear()
            del flat[:], ends[1:]
        raw = data.tobytes()
        at = np.empty(len(unique), np.int64)
        for k, (h, i) in enumerate(zip(unique.tolist(), first.tolist(), strict=True)):
            place = known.get(h)
            if place is None:
                place = known[h] = len(ends) - 1
                flat.extend(whole.encode_ordinary(raw[start[i] : end[i]].decode()))
                ends.append(len(flat))
            at[k] = place
        tokens, until = np.array(flat, np.uint32), np.array(ends, np.int64)
        sizes = (until[at + 1] - until[at])[back]
        before = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        index = np.repeat(until[at][back] - before, sizes) + np.arange(total)
        edges = np.append(before, total)[np.searchsorted(start, offsets)]
        return tokens[index], edges

    return encode


def _cuts(data: np.ndarray, offsets: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Bytes at which texts can be cut without changing their tokens; each text's first among them.

    A match ends where white space begins, where an ASCII letter is followed by another kind of ASCII
    character, and behind a single white space other than a blank. Longer white space is left with
    what follows, as the pattern looks ahead there.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    space, letter, ascii_ = _SPACE[data], _LETTER[data], data < 0x80
    cut = np.zeros(len(data), bool)
    cut[1:] = (space[1:] & ~space[:-1]) | (letter[:-1] & ascii_[1:] & ~letter[1:])
    cut[2:] |= space[1:-1] & (data[1:-1] != 0x20) & ~space[2:] & ~space[:-2]
    for i in np.flatnonzero(wide):
        cut[offsets[i] : offsets[i + 1]] = False
    begins = offsets[:-1][np.diff(offsets) > 0]
    follows = begins[begins + 1 < len(data)]
    cut[follows + 1] &= ~space[follows]  # white space at the very beginning has nothing before it
    cut[begins] = True
    return np.flatnonzero(cut)


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in such a file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


def cut_lengths(tokens: int, capacity: int, slack: float, least: int) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    out = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        j = capacity // rest
        if rest <= least or rest * j >= capacity * (1 - slack):
            out.append(rest)
            break
        out.append(capacity // (j + 1))
        rest -= out[-1]
    return out


class _Piece(NamedTuple):
    doc: object
    doc_tokens: int
    start: int
    tokens: np.ndarray  # its own, not a view of all that was encoded with it

    def part(self, start: int, end: int) -> _Piece:
        return self._replace(start=self.start + start, tokens=self.tokens[start:end])


class _Bins:
    """The open bins of one worker."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[_Piece]] = {}

    def put(self, piece: _Piece) -> Iterator[tuple[_Piece, int, int]]:
        """Pieces that are settled once this one has come, with their sequence and offset."""
        j = self.capacity // len(piece.tokens)
        bin_ = self.open.setdefault(j, [])
        bin_.append(piece)
        if len(bin_) == j:
            del self.open[j]
            yield from self._sequence(bin_)

    def _sequence(self, pieces: list[_Piece]) -> Iterator[tuple[_Piece, int, int]]:
        offset = 0
        for piece in pieces:
            yield piece, self.next, offset
            offset += len(piece.tokens)
        self.next += 1

    def close(self) -> Iterator[tuple[_Piece, int, int]]:
        """The pieces of unfilled bins, end to end."""
        rest = [piece for j in sorted(self.open) for piece in self.open[j]]
        left = sum(len(piece.tokens) for piece in rest)
        sizes = [self.capacity] * (left // self.capacity)
        last = left % self.capacity
        sizes += [1 << k for k in reversed(range(last.bit_length())) if last >> k & 1]
        for size in sizes:
            here = []
            while size:
                piece = rest.pop(0)
                here.append(piece.part(0, size))
                if size < len(piece.tokens):
                    rest.insert(0, piece.part(size, len(piece.tokens)))
                size -= len(here[-1].tokens)
            yield from self._sequence(here)


def packed(
    docs: DataFrame,
    encoder: Callable[[], Encoder],
    end: int | None = 1,
    capacity: int = 2048,
    slack: float = 0.01,
    least: int = 32,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_tokens: bool = False,
) -> DataFrame:
    """One row per piece of a document.

    Columns: the id, ``start`` and ``length`` (its tokens of the document), ``ids_crc32`` (of the
    tokens as unsigned little-endian 32-bit numbers), ``doc_tokens``, ``sequence_id`` and ``offset`` (its
    place there), and with ``with_tokens`` the ``tokens``. Every token lies in one piece. ``encoder`` is
    called once per worker. ``end`` is appended to each document.

    A null text is empty: it has the end token alone, or no row without one. Rows that repeat are
    documents of their own. An empty table gives no rows. Each worker packs the rows of its own
    partition without moving them, and keeps only the unfilled bins. The sequence ids name the
    partition, so a task that runs again gives the same rows if its partition has the same rows in the
    same order, as files have.
    """
    types = StructType.fromDDL(
        "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint" + (", tokens array<bigint>" if with_tokens else "")
    )
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), *types.fields])
    tail = np.array([] if end is None else [end], np.uint32)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        bins = _Bins(capacity, TaskContext.get().partitionId() << 40)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for part in slices(batch, "text", SLICE):
                done = []
                tokens, edges = encode(part.column(1))
                for k, doc in enumerate(part.column(0).to_pylist()):
                    own = np.append(tokens[edges[k] : edges[k + 1]], tail)
                    start = 0
                    for length in cut_lengths(len(own), capacity, slack, least):
                        cut = own[start : start + length].copy()
                        done += bins.put(_Piece(doc, len(own), start, cut))
                        start += length
                if done:
                    yield rows(done, kind)
        done = list(bins.close())
        if done:
            yield rows(done, kind)

    def rows(done: list[tuple[_Piece, int, int]], kind: pa.DataType) -> pa.RecordBatch:
        pieces = [p for p, _, _ in done]
        out = {
            id_col: pa.array([p.doc for p in pieces], kind),
            "start": [p.start for p in pieces],
            "length": [len(p.tokens) for p in pieces],
            "ids_crc32": [zlib.crc32(p.tokens.astype("<u4").tobytes()) for p in pieces],
            "doc_tokens": [p.doc_tokens for p in pieces],
            "sequence_id": [s for _, s, _ in done],
            "offset": [o for _, _, o in done],
        }
        if with_tokens:
            out["tokens"] = pa.array([p.tokens.tolist() for p in pieces], pa.list_(pa.int64()))
        return pa.RecordBatch.from_pydict(out)

    named = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(pack, schema)
