"""Merkle manifests, periodic runs and SimHash near-duplicates against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from topicloom.llm.catalog import llm_oracle, llm_queries
from topicloom.llm.merkle import manifest
from topicloom.llm.runs import collapsed_texts, find_runs, periodic_runs
from topicloom.llm.simhash import cell_masks, groups_for, near_components
from topicloom.llm.words import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def fold(levels, place, own):
    siblings = []
    for level in levels[:-1]:
        run = level[place - place % 3 : place - place % 3 + 3]
        siblings += run[: place % 3] + run[place % 3 + 1 :]
        own = digest(*run[: place % 3], own, *run[place % 3 + 1 :])
        place //= 3
    return siblings, own


def manifest_by_hand(rows, claimed):
    """``rows`` are (id, source, text); ``claimed`` changes a text."""
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        by_source[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = [levels_of([leaf_of(r) for r in by_source[name]]) for name in names]
    top = levels_of([t[-1][0] for t in trees])
    out = []
    for k, name in enumerate(names):
        for place, row in enumerate(by_source[name]):
            low, own = fold(trees[k], place, leaf_of((*row[:2], claimed(row))))
            high, own = fold(top, k, own)
            root = top[-1][0]
            out.append((row[0], leaf_of(row), trees[k][-1][0], root, digest(*low, *high), own, own == root))
    return Counter(out)


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {"a": 2}, {"a": 3, None: 1}, {"a": 82, "b": 1, "": 4}, {"a": 700}, {str(k): k % 5 + 1 for k in range(90)}],
    ids=str,
)
def test_manifest_by_hand(make_docs, sizes):
    rows, number = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            number += 1
            rows.append((number * 37 % 1009, source, f"line é\n{number % 7}" if number % 5 else None))
    random.Random(2).shuffle(rows)
    docs = make_docs(*((i, text, "en", source) for i, source, text in rows))
    broken = F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = manifest(docs, ["doc_id", "source", "text"], claimed=[F.col("doc_id"), F.col("source"), broken])
    expected = manifest_by_hand(
        rows, lambda r: r[2].replace("\n", "") if r[2] is not None and r[0] % 2 == 0 else r[2]
    )
    assert Counter(map(tuple, found.collect())) == expected


def test_manifest_of_odd_rows(odd_docs):
    rows = [(r.doc_id, r.source, r.text) for r in odd_docs.collect()]
    found = manifest(odd_docs, ["doc_id", "source", "text"])
    assert Counter(map(tuple, found.collect())) == manifest_by_hand(rows, lambda r: r[2])
    assert all(r.verified for r in found.collect())
    assert manifest(odd_docs.limit(0), ["doc_id", "text"]).collect() == []


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_manifest_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    table = con.execute(llm_oracle()["op11_merkle_manifest"])
    names = [d[0] for d in table.description]
    found = llm_queries()["op11_merkle_manifest"](spark, sf_dir).select(*names)
    assert Counter(map(tuple, found.collect())) == Counter(table.fetchall())


def test_manifest_climb_is_a_recursive_query(spark, odd_docs, monkeypatch):
    asked = []
    plain = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda s, text, **k: asked.append(text) or plain(s, text, **k))
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    manifest(odd_docs, ["doc_id", "text"]).collect()
    assert any("WITH RECURSIVE" in text for text in asked)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def runs_by_hand(w, times=4, least=6):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            smaller = any(all(w[x] == w[x + p] for x in range(i, i + size - p)) for p in range(1, q))
            if j > i and size >= max(least, times * q) and not smaller:
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed_by_hand(w, runs):
    dropped = {k for start, size, q in runs for k in range(start + q, start + size)}
    return " ".join(x for k, x in enumerate(w) if k not in dropped)


@pytest.mark.parametrize("times, least", [(4, 6), (3, 6), (5, 2), (4, 1)])
def test_runs_by_hand(times, least):
    rng = random.Random(times)
    for _ in range(20):
        texts = [None, "", " \t"]
        for _ in range(25):
            size, kinds = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 60])
            w = [f"w{rng.randrange(kinds)}" if rng.random() < 0.9 else "W0" for _ in range(size)]
            if size and rng.random() < 0.6:
                a = rng.randrange(size)
                p = 1 + rng.randrange(max(1, (size - a) // 3))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(size)]
            texts.append(rng.choice([" ", "\n\t  ", "\x0b"]).join(w) + rng.choice(["", " "]))
        column = pa.array(texts, pa.string())
        found = words(column, lower=False)
        runs = find_runs(found, times, least)
        collapsed = collapsed_texts(column, found, runs).to_pylist()
        for i, text in enumerate(texts):
            w = WORD.findall(text or "")
            expected = runs_by_hand(w, times, least)
            assert [tuple(r[1:]) for r in runs.tolist() if r[0] == i] == expected
            assert collapsed[i] == collapsed_by_hand(w, expected)


def test_runs_of_long_texts():
    period = [f"p{k}" for k in range(5000)]
    text = " ".join(["x"] + period * 5 + period[:17] + ["y"] + ["a b c"] * 40_000)
    found = words(pa.array([text, "z", text]), lower=False)
    runs = [(1, 25_017, 5000), (25_019, 120_000, 3)]
    assert find_runs(found).tolist() == [[i, *r] for i in (0, 2) for r in runs]


def test_runs_of_odd_rows(odd_docs):
    found = periodic_runs(odd_docs)
    expected = Counter()
    for r in odd_docs.collect():
        w = WORD.findall(r.text or "")
        runs = runs_by_hand(w) if len(w) < 1000 else []
        expected[r.doc_id, len(w), tuple(runs), collapsed_by_hand(w, runs)] += 1
    rows = found.collect()
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in rows) == expected
    assert periodic_runs(odd_docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(odd_docs, times=2)


def test_runs_query(spark):
    found = {r.doc_id: r for r in llm_queries()["op12_periodic_runs"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(found) == len(docs)
    seen = 0
    for doc in docs:
        w = WORD.findall(doc.text or "")
        number = zlib.crc32(str(doc.doc_id).encode())
        if number % 10 == 0 and w:
            a = number // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + number // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        if len(w) > 700:
            continue
        runs, r = runs_by_hand(w), found[doc.doc_id]
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == digest(*(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == digest(collapsed_by_hand(w, runs))
        seen += bool(runs)
    assert seen > 3


def simhash(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [w[k : k + size] for k in range(len(w) - size + 1)] or ([w] if w else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints, distance):
    """``prints`` are (id, fingerprint); the smallest id of each one's component."""
    label = list(range(len(prints)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= distance:
                label[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return Counter((i, f"{f:016x}", least.get(root(k))) for k, (i, f) in enumerate(prints))


@pytest.mark.parametrize("members", [3, 4096])
def test_near_components_by_hand(make_docs, members):
    """Chains of changed words round a few texts, with small parts of cells and with none."""
    rng = random.Random(5)
    rows = []
    for group, size in enumerate((90, 40, 10, 1, 1)):
        w = [f"g{group}.{k}" for k in range(70)]
        for _ in range(size):
            if rng.random() < 0.8:
                w[rng.randrange(len(w))] = f"x{rng.random()}"
            rows.append((len(rows) * 7 % 151, " ".join(w), "en", "s"))
    docs = make_docs(*rows)
    expected = components_by_hand([(i, simhash(text, 4)) for i, text, *_ in rows], 4)
    found = near_components(docs, 4, 4, members=members).collect()
    assert Counter(map(tuple, found)) == expected
    assert 5 < len({r.component_id for r in found}) < 140


def test_near_components_of_odd_rows(odd_docs):
    prints = [(r.doc_id, simhash(r.text, 4)) for r in odd_docs.collect()]
    found = near_components(odd_docs, 4, 4)
    assert Counter(map(tuple, found.collect())) == components_by_hand(prints, 4)
    assert near_components(odd_docs.limit(0)).collect() == []


@pytest.mark.parametrize("count", [10, 10**8, 10**11])
@pytest.mark.parametrize("distance", [1, 4, 7])
def test_near_points_share_a_cell(count, distance):
    """However many fingerprints there are, any that differ in ``distance`` bits share a cell."""
    masks = [m % (1 << 64) for m in cell_masks(groups_for(count, distance), distance)]
    rng = np.random.default_rng(distance)
    odd = 0x5555555555555555

    def point(x):
        low, high = x & odd, x >> 1 & odd
        return (low | high) | (low & high) << 1

    for _ in range(200):
        a = int(rng.integers(1 << 63)) * 2 + 1
        b = a
        for bit in rng.choice(64, distance, replace=False):
            b ^= 1 << int(bit)
        assert (point(a) ^ point(b)).bit_count() <= distance
        assert any(point(a) & m == point(b) & m for m in masks)
