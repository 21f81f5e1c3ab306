"""Near duplicates: dense groups without links, clashing names, and documents without languages."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.llm import jaccard
from topicloom.llm.jaccard import drop_near, jaccard_components, overlaps
from topicloom.llm.language import identified

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(texts, size, percent):
    """The number of shingles of each text and the smallest place that links lead to."""
    sets = []
    for text in texts:
        w = WORD.findall(text.lower())
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} - {()}))
    label = list(range(len(texts)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    links = 0
    for a, b in combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            links += 1
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return [(len(sets[k]), root(k)) for k in range(len(texts))], links


@pytest.mark.parametrize("changed, linked", [(3, False), (2, True)])
def test_dense_group(make_docs, monkeypatch, changed, linked):
    """Many copies of one text, each with words changed: few or some links, and packed rows in proportion."""
    rng = random.Random(changed)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(300):
        w = list(base)
        for k in rng.sample(range(200), changed + rng.randrange(2)):
            w[k] = f"x{rng.random()}"
        texts.append(" ".join(w))
    rows = {}
    plain = jaccard.block_pairs

    def counted(members, labels, percent):
        packed = plain(members, labels, percent)
        rows["members"], rows["packed"] = members.count(), packed.count()
        rows["pairs"] = packed.select(F.sum(F.length("pairs") / 2)).first()[0] or 0
        return packed

    monkeypatch.setattr(jaccard, "block_pairs", counted)
    docs = make_docs(*((k, text, "en", "s") for k, text in enumerate(texts)))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, 5, 80).collect()}
    expected, links = by_hand(texts, 5, 80)
    assert found == dict(enumerate(expected))
    assert (links > 1000) == linked
    assert rows["packed"] <= rows["members"]
    if not linked:
        assert rows["pairs"] > 4 * rows["packed"]


def test_pairs_leave_few_cells(make_docs, monkeypatch):
    """Texts alike but not linked share most of their prefixes, and yet a pair is not sent from every cell."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(60):
        w = list(base)
        for k in rng.sample(range(200), 3):
            w[k] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(w))
    sent = []
    plain = jaccard.block_pairs

    def counted(members, labels, percent):
        packed = plain(members, labels, percent)
        for r in packed.collect():
            for code in np.frombuffer(r.pairs, np.uint16).tolist():
                sent.append((r.a, r.b, code))
        return packed

    monkeypatch.setattr(jaccard, "block_pairs", counted)
    docs = make_docs(*((k, text, "en", "s") for k, text in enumerate(texts)))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, 5, 80).collect()}
    assert found == dict(enumerate(by_hand(texts, 5, 80)[0]))
    assert len(set(sent)) > 100
    assert len(sent) <= 2 * len(set(sent))


def test_short_shingles_leave_out_no_link():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 300, 200)).astype(np.uint64) << np.uint64(46) for _ in range(2))
        short = [jaccard._told_apart((s >> np.uint64(48)).astype(np.uint16).tobytes()) for s in (a, b)]
        assert [len(np.unique(s)) for s in short] == [len(a), len(b)]
        assert overlaps([short[0]], [short[1]])[0, 0] >= len(np.intersect1d(a, b))


def test_overlaps(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 7)
    rng = np.random.default_rng(2)
    sides = [[np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(n)] for n in (5, 8)]
    expected = [[len(np.intersect1d(a, b)) for b in sides[1]] for a in sides[0]]
    assert overlaps(*sides).astype(int).tolist() == expected
    none = [np.zeros(0, np.uint64)]
    assert overlaps(none, sides[1]).sum() == 0


def test_columns_may_have_any_name(make_docs):
    docs = make_docs((1, "a b c d e f", "en", "s"), (2, "a b c d e f", "en", "s"), (None, None, "en", "s"))
    for name in ("_kept_id", "kept", "row", "key", "id", "component_id"):
        found = drop_near(docs.withColumn(name, F.lit(3)))
        assert found.columns == [*docs.columns, name]
        assert sorted((r.doc_id or 0, r[name]) for r in found.collect()) == [(0, 3), (1, 3)]


def test_documents_without_languages_stay(make_docs):
    docs = make_docs((1, "one two", None, "s"), (2, "12 3", None, "s"), (3, None, None, "s"), (4, "três", None, "s"))
    assert sorted((r.doc_id, r.lang) for r in identified(docs).collect()) == [(1, None), (4, None)]
