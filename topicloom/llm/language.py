"""Language identification: first the family, then one against one within it.

Features are hashed pairs and triples of neighbouring bytes of letters, over the whole text. A linear
support vector machine for each family (that family against the rest) picks the family; within it one
for each two languages votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from topicloom.llm.sampling import crc_part, linear_svm, per_label
from topicloom.llm.words import slices, text_buffer

UNKNOWN = "und"
WIDTH = 2048  # features
SAMPLE = 4000  # rows that are learned from, over all languages
SLICE = 1 << 20  # bytes of text whose features are counted at once
SNIPPET = 120  # bytes of a learned text that are also learned as a text of their own

# Families of languages by ISO 639-1 code. A language that is not listed is its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "pa", "gu", "ur"),
}

_KIND = np.full(256, 0x20, np.uint8)  # letters in lower case, other ASCII as blanks
_KIND[0x80:] = np.arange(0x80, 0x100)
_KIND[0x61:0x7B] = np.arange(0x61, 0x7B)
_KIND[0x41:0x5B] = np.arange(0x61, 0x7B)


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def features(texts: pa.Array, width: int = WIDTH) -> np.ndarray:
    """A row per text: square roots of the shares of its hashed byte pairs and triples."""
    data, offsets = text_buffer(texts)
    docs = len(offsets) - 1
    if not len(data):
        return np.zeros((docs, width), np.float32)
    data = _KIND[data].astype(np.uint32)
    doc = np.repeat(np.arange(docs, dtype=np.int64) * width, np.diff(offsets))
    pairs = (data[:-1] << 8 | data[1:]) * np.uint32(0x9E3779B1)
    blank = data == 0x20
    same = (doc[:-1] == doc[1:]) & ~(blank[:-1] & blank[1:])
    shift = np.uint32(32 - int(width).bit_length() + 1)
    counts = np.bincount(doc[:-1][same] + (pairs >> shift)[same], minlength=docs * width)
    triples = ((data[:-2] << 16 | data[1:-1] << 8 | data[2:]) + np.uint32(1 << 24)) * np.uint32(
        0x85EBCA6B
    )
    same = same[:-1] & same[1:]
    counts += np.bincount(doc[:-2][same] + (triples >> shift)[same], minlength=docs * width)
    counts = counts.reshape(docs, width)
    return np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True))).astype(np.float32)


class Model(NamedTuple):
    """Languages by family, and the weights of the machines: of families, then of pairs."""

    families: list[str]
    languages: list[list[str]]
    family_weights: np.ndarray
    family_offsets: np.ndarray
    pair_weights: dict[tuple[str, str], tuple[np.ndarray, float]]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score (0 to 1) of each row."""
        margins = x @ self.family_weights.T + self.family_offsets
        best = margins.argmax(axis=1)
        weight = np.exp(4 * (margins - margins.max(axis=1, keepdims=True)))
        score = weight.max(axis=1) / weight.sum(axis=1)
        lang = np.empty(len(x), object)
        for k, langs in enumerate(self.languages):
            at = np.flatnonzero(best == k)
            if not len(at):
                continue
            votes = np.zeros((len(at), len(langs)))
            sure = np.zeros((len(at), len(langs)))
            for i, j in combinations(range(len(langs)), 2):
                w, b = self.pair_weights[langs[i], langs[j]]
                p = 1 / (1 + np.exp(-np.clip(4 * (x[at] @ w + b), -50, 50)))
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
                sure[:, i] += p
                sure[:, j] += 1 - p
            others = max(1, len(langs) - 1)
            pick = (votes + sure / (2 * others)).argmax(axis=1)
            lang[at] = np.array(langs, object)[pick]
            if len(langs) > 1:
                score[at] *= sure[np.arange(len(at)), pick] / others
        return lang, score


def fit(x: np.ndarray, labels: list[str]) -> Model | None:
    """The machines learned from feature rows and their languages; None without any rows."""
    if not labels:
        return None
    x = np.asarray(x, dtype=np.float32)
    lang = np.array(labels, object)
    group = np.array([family(v) for v in labels], object)
    families = sorted(set(group))
    languages = [sorted(set(lang[group == f])) for f in families]
    one = [
        linear_svm(x, np.where(group == f, 1.0, -1.0)) if len(families) > 1 else (np.zeros(x.shape[1]), 0.0)
        for f in families
    ]
    pairs = {}
    for langs in languages:
        for a, b in combinations(langs, 2):
            rows = (lang == a) | (lang == b)
            pairs[a, b] = linear_svm(x[rows], np.where(lang[rows] == a, 1.0, -1.0))
    weights = np.array([w for w, _ in one]), np.array([b for _, b in one])
    return Model(families, languages, *weights, pairs)


def learn(
    docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> Model | None:
    """Fit on about ``sample`` rows with a language, the same number of each.

    A learned text counts as a whole and, so that short texts are known too, by a piece of it. Rows
    whose text has no letter are not learned.
    """
    rows = docs.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(id_col)).alias("_order"),
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    chosen = per_label(rows, "lang", F.col("_order"), sample).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts = part.column("text")
                middles = [
                    t[(at := max(0, len(t) // 2 - SNIPPET // 2)) : at + SNIPPET].decode(errors="ignore")
                    for t in texts.cast(pa.binary()).to_pylist()
                ]
                for column in (texts, pa.array(middles, pa.string())):
                    rows = [v.tobytes() for v in features(column).astype(np.float16)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("lang"), pa.array(rows, pa.binary())], ["lang", "x"]
                    )

    got = chosen.mapInArrow(vectors, "lang string, x binary").collect()  # a bounded sample
    got.sort(key=lambda r: (r.lang, bytes(r.x)))
    labels = [r.lang for r in got]
    x = np.empty((len(got), WIDTH), np.float32)
    for k in range(len(got)):
        x[k], got[k] = np.frombuffer(got[k].x, np.float16), None  # let go at once
    return fit(x, labels)


def lettered(texts: pa.Array) -> pa.Array:
    """Which texts have a letter."""
    return pc.match_substring_regex(texts.cast(pa.large_string()), r"\p{L}").fill_null(False)


def guesses(model: Model | None, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of texts; ``und`` and 0 for one without a letter or without a model."""
    known = np.asarray(lettered(texts), dtype=bool)
    lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    if model is not None:
        guess, sure = model.predict(features(texts))
        lang, score = np.where(known, guess, lang), np.where(known, sure, score)
    return lang, score


def identified(
    docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` whose language is known, all columns as they came but for a null language.

    Rows that are ``und`` (see ``languages``) go; a null language becomes the predicted one. Rows do
    not move. Learned from the rows that have a language; if there are none, languages stay null and only rows
    without a letter go.
    """
    model = docs.sparkSession.sparkContext.broadcast(
        learn(docs, sample, id_col, text_col, lang_col)
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                if model.value is None:
                    yield part.filter(lettered(part.column(text_col)))
                    continue
                lang, _ = guesses(model.value, part.column(text_col))
                at = part.schema.get_field_index(lang_col)
                kind = part.schema.field(at).type
                filled = pc.coalesce(part.column(at), pa.array(lang, pa.string()).cast(kind))
                part = part.set_column(at, part.schema.field(at), filled)
                yield part.filter(pa.array(lang != UNKNOWN, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def languages(
    docs: DataFrame,
    learn_from: DataFrame | None = None,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The id, ``lang_pred`` and ``score`` (0 to 1) of each row of ``docs``.

    Learned from the rows of ``learn_from`` (``docs`` itself if not given) that have a language, about
    ``sample`` of them. A text that is null, empty or has no letter is ``und`` with score 0, and so is
    every text if there is nothing to learn from. Texts are read whole. Repeated rows get equal
    results; no rows give no rows. Only the id and the text are looked at here.
    """
    source = docs if learn_from is None else learn_from
    model = docs.sparkSession.sparkContext.broadcast(
        learn(source, sample, id_col, text_col, lang_col)
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                lang, score = guesses(model.value, part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score)],
                    [id_col, "lang_pred", "score"],
                )

    schema = StructType(
        [StructField(id_col, docs.schema[id_col].dataType)]
        + StructType.fromDDL("lang_pred string, score double").fields
    )
    named = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(predict, schema)


def with_held_out(docs: DataFrame, parts: int, held: int, id_col: str = "doc_id") -> DataFrame:
    """The rows that may be learned from: those whose CRC-32 leaves another remainder."""
    return docs.where(crc_part(id_col, parts) != held)
