"""Likeness of fingerprints against the texts' sentences themselves."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from topicloom.llm import multiset
from topicloom.llm.multiset import edited_fingerprints, fingerprints, likeness, minus, plus


def sentences(text):
    return Counter(s for line in text.split("\n") if line for s in re.split(r"(?<=[.!?]) +", line))


def by_hand(a, b):
    a, b = sentences(a), sentences(b)
    differ, total = sum(abs(a[k] - b[k]) for k in a | b), a.total() + b.total()
    return 1.0 if not differ else (total - differ) / (total + differ)


def lines(*counts):
    return "\n".join(f"{name} {k % kinds}" for name, n, kinds in counts for k in range(n))


PAIRS = [
    (lines(("a", 60, 60)), lines(("a", 30, 30))),
    (lines(("a", 30, 30), ("same", 30, 1)), lines(("a", 30, 30), ("same", 15, 1))),  # a line that repeats
    (lines(("x", 5000, 1)), lines(("x", 2500, 1), ("y", 10, 10))),
    (lines(("a", 200_000, 200_000)), lines(("a", 100_000, 100_000))),  # beyond 2**16 sentences
    (lines(("a", 40, 40)), lines(("b", 40, 40))),
    (lines(("a", 40, 40)), lines(("a", 40, 40))),
    (lines(("a", 40, 40)), ""),
]


def test_likeness_by_hand(spark):
    rows = [(2 * k + i, text) for k, pair in enumerate(PAIRS) for i, text in enumerate(pair)]
    made = fingerprints(spark.createDataFrame(rows, "k int, t string"), ["k"], "t", "fp").collect()
    held = {r.k: r.fp for r in made}
    pairs = spark.createDataFrame([(k, held[2 * k], held[2 * k + 1]) for k in range(len(PAIRS))], "k int, a array<long>, b array<long>")
    found = {r.k: r.near for r in pairs.select("k", likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    for k, (a, b) in enumerate(PAIRS):
        assert found[k] == pytest.approx(by_hand(a, b) if a and b else 0.0, abs=0.12), k
    assert found[5] == 1.0


def test_sums_stay_sums(spark):
    """Texts put together and taken apart, also far beyond the lanes of short texts."""
    a, b = lines(("a", 70_000, 9)), lines(("b", 3, 3), ("a", 5, 2))
    rows = [(1, a + "\n" + b), (2, a), (3, b)]
    held = {r.k: F.lit(r.fp) for r in fingerprints(spark.createDataFrame(rows, "k int, t string"), ["k"], "t", "fp").collect()}
    row = spark.range(1).select(
        (plus(held[2], held[3]) == held[1]).alias("plus"), (minus(held[1], held[3]) == held[2]).alias("minus")
    ).first()
    assert tuple(row) == (True, True)


def test_likeness_of_documents(spark):
    """Near the truth on the test table, for the edited text and for the next document."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    found = {r.doc_id: r for r in edited_fingerprints(docs).collect()}
    off = []
    for k, (doc, text) in enumerate(texts):
        after, half = texts[(k + 1) % len(texts)][1], len(text) // 2
        off.append(found[doc].near_edited - by_hand(text, text[: len(text) - half] + after[:half]))
        off.append(found[doc].near_next - by_hand(text, after))
    assert sum(map(abs, off)) / len(off) < 0.05
    assert sum(abs(x) > 0.2 for x in off) < 0.02 * len(off)


def test_fingerprints_are_moved_in_one_exchange(make_docs, monkeypatch):
    """A text's fingerprint goes to its row and the one before it; an edited one is not moved, none is written down."""
    written, real = [], multiset.saved
    monkeypatch.setattr(multiset, "saved", lambda df, name: written.append(df.columns) or real(df, name))
    found = edited_fingerprints(make_docs((1, "One. Two.\nThree.", "en", "s"), (2, "One. Two.", "en", "s")))
    assert not [c for c in written if any(name.startswith("fp") for name in c)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    below = [plan[k + 1] for k, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert sum("max" in line for line in below) == 1
    assert not [line for line in below if "fp_edited" in line]
    assert found.schema["near_next"].dataType.typeName() == "double"
