"""Pairs of texts verified in cells, and members of a signature compared across labels."""

from collections import Counter

import numpy as np
import pytest

from topicloom.llm import windows
from topicloom.llm.windows import common_stretches, pairs_apart, repeated_passages, roots, stretches, verified_spans


def test_stretches_of_many_texts():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 120, 300)
    cut = np.append(0, np.cumsum(sizes))
    there = rng.random(cut[-1]) < np.repeat(rng.choice([0, 0.5, 0.9, 0.97, 1], 300), sizes)
    row, start, end = stretches(there, cut, 20)
    found = [[] for _ in sizes]
    for k, p, q in zip(row.tolist(), start.tolist(), end.tolist(), strict=True):
        found[k].append((p, q))
    for k, size in enumerate(sizes):
        own = there[cut[k] : cut[k + 1]]
        assert found[k] == common_stretches(np.arange(size), np.flatnonzero(own), 20)
        inside = np.append(0, np.cumsum(own))
        assert all(9 * (inside[q] - inside[p]) >= 8 * (q - p) >= 160 for p, q in found[k])
    assert len(row) > 100 and not len(stretches(there[:0], np.zeros(3, int), 1)[0])


def test_roots():
    rng = np.random.default_rng(4)
    p, q = rng.integers(0, 500, (2, 300))
    wanted = list(range(500))
    for _ in range(500):
        for a, b in zip(p.tolist(), q.tolist(), strict=True):
            wanted[a] = wanted[b] = min(wanted[a], wanted[b])
    assert roots(500, p, q).tolist() == wanted


@pytest.mark.parametrize("most", [0.0, 0.4, 0.9])
def test_pairs_apart(most):
    rng = np.random.default_rng(5)
    for size in (2, 7, 60):
        parts = [rng.integers(0, 60, rng.integers(0, 60)).astype(np.uint32) for _ in range(size)]
        ids = rng.permutation(size)
        lo = np.where(rng.random(size) < most, 3, rng.integers(0, 9, size))
        hi = lo + (rng.random(size) < 0.1)
        wanted = set()
        for i in range(size):
            for j in range(i):
                shared = min(np.isin(parts[i], parts[j]).sum(), np.isin(parts[j], parts[i]).sum())
                if shared >= 25 and min(lo[i], lo[j]) != max(hi[i], hi[j]):
                    wanted.add(frozenset((int(ids[i]), int(ids[j]))))
        found = [frozenset(r) for r in pairs_apart(parts, ids, lo, hi, 25).tolist()]
        assert set(found) == wanted and len(found) == len(wanted)


@pytest.mark.parametrize("limits", [{}, {"CELL": 1, "CELLS": 3}])
def test_rows_follow_texts_and_not_pairs(spark, monkeypatch, limits):
    """All pairs of 40 texts that share a passage are verified; each text gives a row for each task."""
    for name, value in limits.items():
        monkeypatch.setattr(windows, name, value)
    rng = np.random.default_rng(6)
    shared = rng.integers(0, 2**32, 80)
    texts = [np.concatenate([rng.integers(0, 2**32, k), shared, rng.integers(0, 2**32, 9)]) for k in range(40)]
    texts = [bytearray(x.astype(np.uint32).tobytes()) for x in texts]
    texts = [(k << 57, like, x) for k, x in enumerate(texts) for like in (100 - k, 200)]  # another one's is not taken
    pairs = [(a << 57, b << 57) for b in range(40) for a in range(b)]
    found = verified_spans(
        spark.createDataFrame(pairs, "a bigint, b bigint"),
        spark.createDataFrame(texts, "id bigint, like_id bigint, x binary"),
        spark.createDataFrame([(k << 57, 100 - k, 100) for k in range(40)], "id bigint, rep bigint, n int"), 50,
    ).collect()
    assert {(r.id >> 57, r.start, r.end) for r in found} == {(k, k, k + 84) for k in range(40)}
    least = {k: min((r.like_id, r.like_start, r.like_end) for r in found if r.id >> 57 == k) for k in range(40)}
    assert least == {k: (61, 39, 123) if k < 39 else (62, 38, 122) for k in range(40)}
    assert len(found) == 40 if not limits else 40 < len(found) < 40 * 40
    joined = {}
    for r in found:
        joined.setdefault(r.joined, set()).add(r.id >> 57)
    group = {0}
    for _ in range(40):
        group |= set().union(*(ids for ids in joined.values() if ids & group))
    assert None not in joined and group == set(range(40))


@pytest.mark.parametrize("limits", [{"CELL": 1, "CELLS": 3, "COMPARED": 1}, {"CELL": 1, "MEMBERS": 4, "APART": 0}])
def test_cells_decide_nothing(make_docs, monkeypatch, limits):
    rng = np.random.default_rng(7)
    rows = []
    for doc in range(60):
        body = [f"{doc % 4}.{k}" for k in range(150)]
        for k in rng.choice(150, 3, replace=False):
            body[k] = f"x{doc}.{k}"
        rows.append((doc, " ".join([*(f"d{doc}.{k}" for k in range(doc)), *body]), "en", "s"))
    wanted = sorted(repeated_passages(make_docs(*rows)).collect())
    for name, value in limits.items():
        monkeypatch.setattr(windows, name, value)
    assert sorted(repeated_passages(make_docs(*rows)).collect()) == wanted
    assert {r.doc_id for r in wanted} == set(range(60)) and len({r.passage for r in wanted}) == 4


def test_rows_of_the_same_id_keep_their_own_texts(make_docs):
    """Two texts of one id have a passage at different places; neither gets the other's."""
    shared = " ".join(f"s{k}" for k in range(60))
    first, second = " ".join(f"a{k}" for k in range(10)), " ".join(f"b{k}" for k in range(25))
    rows = [(1, f"{first} {shared}", "en", "s"), (1, f"{second} {shared}", "en", "s"), (2, shared, "en", "s")]
    found = repeated_passages(make_docs(*rows)).collect()
    assert Counter((r.doc_id, r.start, r.end) for r in found) == Counter([(1, 10, 70), (1, 25, 85), (2, 0, 60)])
