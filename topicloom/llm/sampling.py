"""Bounded samples for fitting classifiers, and learning parts of a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_part(id_col: str, parts: int) -> Column:
    """The remainder of the CRC-32 of an id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def per_label(rows: DataFrame, label: str, order: Column, total: int) -> DataFrame:
    """About ``total`` rows, the same number for each label as far as it has them.

    The rows with the lowest hashes are taken, by a limit on the hash that the labels' counts give, so
    nothing is sorted. The number is random by its square root only. There must not be more labels
    than ``total``; the counts per label are the only thing that reaches the driver.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().limit(total).collect()}
    if not counts:
        return rows.limit(0)
    each = max(1, total // len(counts))
    share = F.create_map(
        *(F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1.0, each / n)))
    )
    place = F.pmod(order, F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(place < F.element_at(share, F.col(label)))


def linear_svm(
    x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 300
) -> tuple[np.ndarray, float]:
    """Weights and offset that minimise mean squared hinge loss plus a squared norm; y is 1 or -1.

    Both signs weigh the same, whatever their number. Accelerated gradient steps on all rows.
    """
    rows = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)
    y = y.astype(x.dtype)  # no product makes a wider copy of x
    w, b = np.zeros(x.shape[1], x.dtype), x.dtype.type(0)
    v, c = w, b
    step = 1 / (4 * float((rows * (np.einsum("ij,ij->i", x, x) + 1)).sum()) + penalty)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v + c)) * rows * y
        new_w = (v + step * (2 * (x.T @ slack) - penalty * v)).astype(x.dtype)
        new_b = x.dtype.type(c + step * 2 * slack.sum())
        pace = x.dtype.type(k / (k + 3))
        v, c = new_w + pace * (new_w - w), new_b + pace * (new_b - b)
        w, b = new_w, new_b
    return w, b
