"""Toxicity by non-negative positive-unlabelled learning.

Learned from texts confirmed as toxic and from unlabelled ones. What a classifier loses on unlabelled
texts as if they were all clean is corrected by the share of toxic ones among them, the class prior;
where the corrected loss falls below zero, a step is taken back. Each of a few numpy classifiers is
trained in a task of its own on another sample of unlabelled texts; their weights are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from topicloom.llm.words import hash_ranges, mix, slices, text_buffer, words

WIDTH = 1 << 18  # features
POSITIVES = 1500  # toxic texts that are learned from
UNLABELLED = 2500  # unlabelled texts that one classifier learns from
MEMBERS = 3
PRIOR = 0.1  # if no row is labelled as clean
SCALE = 10.0


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, features and values of texts: whole words, and words' first four and five bytes.

    The value is the square root of the feature's share of the text's words. With ``wanted`` (a flag
    per feature) the others are left out.
    """
    found = words(texts)
    data, _ = text_buffer(texts)
    lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    parts = [found.hash]
    for k in (4, 5):
        head = np.minimum(found.end, found.start + k)
        parts.append(mix(hash_ranges(lower, found.start, head) + np.uint64(k)))
    doc = np.tile(found.doc, len(parts)).astype(np.uint64)
    feature = np.concatenate(parts) & np.uint64(WIDTH - 1)
    if wanted is not None:
        on = wanted[feature.astype(np.int64)]
        doc, feature = doc[on], feature[on]
    both, counts = np.unique(doc * np.uint64(WIDTH) + feature, return_counts=True)
    doc = (both // np.uint64(WIDTH)).astype(np.int64)
    total = np.bincount(found.doc, minlength=found.docs)
    value = SCALE * np.sqrt(counts / total[doc])
    return doc, (both % np.uint64(WIDTH)).astype(np.int64), value


class Rows(NamedTuple):
    """A sparse matrix."""

    count: int
    row: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def margins(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.count) + b

    def back(self, g: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, self.value * g[self.row], width)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def risks(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """Risk on the positive side, and the corrected risk on the negative side, from margins."""
    plus = prior * np.logaddexp(0, -p).mean()
    return plus, np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()


def train(
    positive: Rows, unlabelled: Rows, prior: float, width: int, rounds: int = 300,
    pace: float = 0.05, penalty: float = 1e-3, back: float = 0.5,
) -> tuple[np.ndarray, float]:
    """Weights and offset that minimise the non-negative risk under logistic loss (Adam steps).

    While the corrected risk on the negative side is below zero, ``back`` of its step is taken back.
    """
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for k in range(1, rounds + 1):
        p, u = positive.margins(w, b), unlabelled.margins(w, b)
        as_clean_p = prior * _sigmoid(p) / positive.count  # what the correction takes off
        as_clean_u = _sigmoid(u) / unlabelled.count
        if risks(p, u, prior)[1] >= 0:
            gp, gu = -prior * _sigmoid(-p) / positive.count - as_clean_p, as_clean_u
        else:
            gp, gu = back * as_clean_p - prior * _sigmoid(-p) / positive.count, -back * as_clean_u
        grad = positive.back(gp, width) + unlabelled.back(gu, width) + penalty * w
        grad = np.append(grad, gp.sum() + gu.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        step = pace * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def _stack(parts: list[tuple[bytes, bytes]]) -> Rows:
    columns = [np.frombuffer(c, np.int32) for c, _ in parts]
    rows = np.repeat(np.arange(len(parts)), [len(c) for c in columns])
    values = [np.frombuffer(v, np.float32) for _, v in parts]
    return Rows(len(parts), rows, np.concatenate(columns).astype(np.int64), np.concatenate(values))


def marked_features(positive: Rows, unlabelled: Rows) -> np.ndarray:
    """Features that toxic texts have at least twice as often as unlabelled ones, beyond chance."""
    p = np.bincount(positive.column, minlength=WIDTH) / positive.count
    u = (np.bincount(unlabelled.column, minlength=WIDTH) + 1) / unlabelled.count
    beyond = p - u > 4 * np.sqrt(u / positive.count)
    return np.flatnonzero((p * positive.count >= 5) & beyond & (p > 2 * u))


def fit_member(toxic: list, other: list, prior: float) -> tuple[np.ndarray, float]:
    """One classifier over all features, from encoded rows; unmarked features have no weight."""
    positive, unlabelled = _stack(toxic), _stack(other)
    kept = marked_features(positive, unlabelled)
    place = np.full(WIDTH, -1)
    place[kept] = np.arange(len(kept))

    def narrow(rows: Rows) -> Rows:
        on = place[rows.column] >= 0
        return Rows(rows.count, rows.row[on], place[rows.column[on]], rows.value[on])

    small, b = train(narrow(positive), narrow(unlabelled), prior, len(kept))
    w = np.zeros(WIDTH)
    w[kept] = small
    return w, b


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    members: int = MEMBERS,
) -> tuple[np.ndarray, float]:
    """Averaged weights and offset, learned from the given rows.

    Bounded by about ``positives`` toxic texts and ``unlabelled`` others for each of ``members``. The
    class prior is the toxic share of the labelled rows. An id that is labelled twice is toxic if any
    row says so; a null label is none. Without toxic texts every text scores the prior.
    """
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    marked = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_toxic"))
        .where("_id IS NOT NULL AND _toxic IS NOT NULL")
        .groupBy("_id")
        .agg(F.max("_toxic").alias("_toxic"))
    )
    order = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    toxic, clean, rows = 0, 0, named.count()
    for r in marked.groupBy("_toxic").count().where("_toxic IN (0, 1)").collect():
        toxic, clean = (r[1], clean) if r[0] else (toxic, r[1])
    prior = toxic / (toxic + clean) if clean else PRIOR
    prior = min(max(prior, 0.001), 0.9)
    flat = np.zeros(WIDTH), float(np.log(prior / (1 - prior)))
    if not toxic or not rows:
        return flat
    ids = marked.where((F.col("_toxic") == 1) & (order < min(1.0, positives / toxic))).select("_id")
    # The ids are a bounded sample, so they may be broadcast.
    chosen = named.join(F.broadcast(ids), "_id").select(
        "text", F.lit(True).alias("toxic"), F.explode(F.sequence(F.lit(0), F.lit(members - 1))).alias("member")
    )
    other = named.where(order < min(1.0, members * unlabelled / rows)).select(
        "text", F.lit(False).alias("toxic"), F.pmod(F.xxhash64("_id", F.lit(1)), members).cast("int").alias("member")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                doc, feature, value = features(part.column("text"))
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                feature, value = feature.astype(np.int32), value.astype(np.float32)
                spans = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), part.column("member"),
                     pa.array([feature[a:b].tobytes() for a, b in spans], pa.binary()),
                     pa.array([value[a:b].tobytes() for a, b in spans], pa.binary())],
                    ["toxic", "member", "f", "v"],
                )

    def fit(pdf):
        pdf = pdf.sort_values(["f", "v"])  # in the same order whatever order they came in
        on = pdf["toxic"].to_numpy(bool)
        parts = list(zip(pdf["f"], pdf["v"], strict=True))
        toxic = [p for p, t in zip(parts, on, strict=True) if t]
        rest = [p for p, t in zip(parts, on, strict=True) if not t]
        if not toxic or not rest:
            return pdf.iloc[:0].assign(w=b"", b=0.0)[["member", "w", "b"]]
        w, b = fit_member(toxic, rest, prior)
        return pdf.head(1).assign(w=[w.astype(np.float32).tobytes()], b=[b])[["member", "w", "b"]]

    coded = chosen.unionByName(other).mapInArrow(encode, "toxic boolean, member int, f binary, v binary")
    made = coded.groupBy("member").applyInPandas(fit, "member int, w binary, b double").collect()
    if not made:
        return flat
    made.sort(key=lambda r: r.member)
    w = np.mean([np.frombuffer(r.w, np.float32) for r in made], axis=0)
    return w.astype(np.float64), float(np.mean([r.b for r in made]))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: DataFrame | None = None,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    **how: object,
) -> DataFrame:
    """The id, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) of each row of ``docs``.

    Learned from the rows of ``learn_from`` (``docs`` itself if not given) and the ``labels`` of those
    ids; only the text is looked at in a score. Texts are read whole; a null text is empty, and an
    empty one scores the offset alone. Equal texts score the same; no rows give no rows.
    """
    source = docs if learn_from is None else learn_from
    known = labels if learn_from is None else labels.join(
        learn_from.select(id_col).distinct(), id_col, "left_semi")
    model = docs.sparkSession.sparkContext.broadcast(learn(source, known, id_col, text_col, **how))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = model.value
        wanted = w != 0
        for batch in batches:
            for part in slices(batch, "text"):
                doc, feature, value = features(part.column(1), wanted)
                z = np.bincount(doc, value * w[feature], part.num_rows) + b
                score = _sigmoid(z)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    [id_col, "score", "predicted"],
                )

    schema = StructType(
        [StructField(id_col, docs.schema[id_col].dataType)]
        + StructType.fromDDL("score double, predicted int").fields
    )
    named = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(predict, schema)
