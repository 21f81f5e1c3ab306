"""Tables of counters of a fixed size, summed over all tasks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

CHUNKS = 64
SCHEMA = "chunk int, salt int, counts binary"


def counter_rows(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's counters as rows of ``SCHEMA``; their number must be a multiple of ``CHUNKS``."""
    salt = TaskContext.get().partitionId() % 256
    for k, chunk in enumerate(np.split(table.astype(np.int64), CHUNKS)):
        if chunk.any():
            packed = zlib.compress(chunk.tobytes(), 1)
            columns = [pa.array([k], pa.int32()), pa.array([salt], pa.int32()), pa.array([packed])]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "salt", "counts"])


def summed(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' counters: chunk by chunk, in two steps, and ``size`` numbers at last."""

    def add(pdf):
        total = np.zeros(size // CHUNKS, np.int64)
        for packed in pdf["counts"]:
            total += np.frombuffer(zlib.decompress(packed), np.int64)
        return pdf.head(1).assign(counts=[zlib.compress(total.tobytes(), 1)])

    table = np.zeros((CHUNKS, size // CHUNKS), np.int64)
    parts = rows.groupBy("chunk", "salt").applyInPandas(add, SCHEMA)
    for row in parts.groupBy("chunk").applyInPandas(add, SCHEMA).collect():  # at most 64 rows
        table[row.chunk] = np.frombuffer(zlib.decompress(bytes(row.counts)), np.int64)
    return table.ravel()
