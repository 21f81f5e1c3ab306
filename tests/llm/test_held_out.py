"""Held-out figures of the classifiers, and the first stages of the pipeline by hand."""

import zlib

import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from test_near import by_hand
from topicloom.llm.catalog import llm_queries
from topicloom.llm.language import languages, with_held_out

SF_DIR = "/root/testdata/sf0.01"


def part(doc, parts):
    return zlib.crc32(str(doc).encode()) % parts


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_languages_held_out(spark, documents):
    found = {r.doc_id: r for r in llm_queries()["op10_language_id"](spark, SF_DIR).collect()}
    assert set(found) == set(documents)
    known = {r.lang for r in documents.values() if r.lang is not None and part(r.doc_id, 4) != 2}
    right = []
    for doc, r in found.items():
        text = documents[doc].text
        assert r.held_out == (part(doc, 4) == 2) and 0 <= r.score <= 1
        if text is None or not regex.search(r"\p{L}", text):
            assert r.lang_pred == "und"
            continue
        assert r.lang_pred in known
        if r.held_out and documents[doc].lang is not None:
            right.append(r.lang_pred == documents[doc].lang)
    assert len(right) > 150 and sum(right) / len(right) >= 0.97


def test_languages_look_at_the_text_alone(spark):
    """Held-out rows get the same language whatever stands in their other columns."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learn = with_held_out(docs, 4, 2)
    held = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    other = held.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    other = other.withColumn("doc_id", -F.col("doc_id"))
    plain = {r.doc_id: (r.lang_pred, r.score) for r in languages(held, learn).collect()}
    assert plain == {-r.doc_id: (r.lang_pred, r.score) for r in languages(other, learn).collect()} != {}


def test_toxicity_held_out(spark, documents):
    found = {r.doc_id: r for r in llm_queries()["op5_toxicity"](spark, SF_DIR).collect()}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert set(found) == set(documents)
    for doc, r in found.items():
        assert r.held_out == (part(doc, 4) == 2) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    bad = [found[d].score for d, t in toxic.items() if t == 1 and d in found and found[d].held_out]
    good = [found[d].score for d, t in toxic.items() if t == 0 and d in found and found[d].held_out]
    # Texts without anything that tells are alike, so ties count half.
    above = sum((b > g) + (b == g) / 2 for b in bad for g in good)
    assert above / (len(bad) * len(good)) >= 0.75
    assert sum(b >= 0.3 for b in bad) >= len(bad) / 2 and sum(g >= 0.3 for g in good) <= 0.05 * len(good)


def test_first_stages_by_hand(spark):
    """Language, exact and near duplicates over the small table, each on what the one before keeps."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    known = stages["language_id"](spark, docs, sf_dir)
    expected = {d for d, r in rows.items() if r.text is not None and regex.search(r"\p{L}", r.text)}
    kept = {r.doc_id: r for r in known.collect()}
    assert set(kept) == expected and known.columns == docs.columns
    assert all(kept[d].lang == rows[d].lang for d in kept if rows[d].lang is not None)

    exact = stages["exact_dedup"](spark, known, sf_dir)
    first = {}
    for d in sorted(expected):
        first.setdefault(rows[d].text, d)
    assert {r.doc_id for r in exact.collect()} == set(first.values())

    near = stages["near_dedup"](spark, exact, sf_dir)
    ids = sorted(first.values())
    of, _ = by_hand([rows[d].text for d in ids], 5, 80)
    left = {ids[k] for k, (size, root) in enumerate(of) if root == k or not size}
    found = near.collect()
    assert {r.doc_id for r in found} == left and len(found) == len(left) < len(ids)
    assert all(r.text == rows[r.doc_id].text for r in found)
