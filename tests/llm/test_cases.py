"""Every operator on odd rows and on none, and small brute-force versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from functools import partial
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from topicloom.llm import ngram_lm, toxicity, windows
from topicloom.llm.elias_fano import EliasFano, Trie
from topicloom.llm.exact import drop_exact, exact_groups
from topicloom.llm.jaccard import drop_near, jaccard_components
from topicloom.llm.language import identified, languages
from topicloom.llm.mixing import mix, mixed
from topicloom.llm.multiset import edited_fingerprints, fingerprints, minus, plus
from topicloom.llm.packing import byte_bpe, packed
from topicloom.llm.quotes import linked_conversations
from topicloom.llm.windows import (
    common_stretches,
    exact_pairs,
    rare_values,
    repeated_passages,
    window_centres,
    window_hashes,
)
from topicloom.session import scratch_scope

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
pack = partial(packed, encoder=partial(byte_bpe, BPE))


def score(docs):
    return ngram_lm.score(docs, ngram_lm.fit(docs))


def toxic(docs):
    labels = docs.select("doc_id", (F.col("doc_id") == 1).cast("int").alias("toxic"))
    return toxicity.toxicity(docs, labels)


PER_ROW = [score, edited_fingerprints, toxic, exact_groups, mix, jaccard_components, languages]
KEEP = [drop_exact, drop_near, identified, mixed]


@pytest.mark.parametrize("operator", PER_ROW, ids=lambda f: f.__name__)
def test_odd_rows(odd_docs, operator):
    found = operator(odd_docs)
    assert found.count() == odd_docs.count()
    assert operator(odd_docs.limit(0)).collect() == []


@pytest.mark.parametrize("operator", KEEP, ids=lambda f: f.__name__)
def test_filters_keep_columns(odd_docs, operator):
    found = operator(odd_docs)
    assert found.columns == odd_docs.columns and found.count() > 0
    assert operator(odd_docs.limit(0)).collect() == []


def test_odd_rows_of_the_others(odd_docs):
    pieces = pack(odd_docs)
    assert pieces.agg(F.sum("length")).first()[0] > 60_000
    assert pack(odd_docs.limit(0)).collect() == []
    passages = repeated_passages(odd_docs, least=10)
    assert {r.doc_id for r in passages.collect()} == {1, 2}
    assert repeated_passages(odd_docs.limit(0)).collect() == []


def test_exact_groups(odd_docs):
    rows = exact_groups(odd_docs, stays="largest").collect()
    same = [r for r in rows if r.doc_id in (1, 2)]
    assert [(r.keep_id, r.group_size) for r in same] == [(2, 3)] * 3 and sum(r.kept for r in same) == 1
    empty = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {(r.doc_id, r.keep_id) for r in empty} == {(3, 4), (4, 4)}


def test_jaccard_components(make_docs):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(60)]
    texts = {}
    for i in range(60):
        words = list(base) if i < 40 else [f"v{i}_{k}" for k in range(30)]
        for k in rng.integers(0, len(words), rng.integers(0, 5)):
            words[k] = f"x{i}_{k}"
        texts[i] = " ".join(words)
    texts |= {60: None, 61: "", 62: "w1 w2", 63: "W1  w2"}
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").lower())
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} - {()}
    label = {i: i for i in sets}
    for _ in sets:
        for i, j in ((i, j) for i in sets for j in sets if i < j and sets[i] and sets[j]):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[i] = label[j] = min(label[i], label[j])
    docs = make_docs(*((i, t, "en", "s") for i, t in texts.items()))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, 3, 80).collect()}
    assert found == {i: (len(s), label[i]) for i, s in sets.items()}
    assert len(set(label.values())) > 25


def test_fingerprints_add_up(spark):
    rows = [(1, "a\nb b. c\n\na"), (2, "a"), (3, "b b. c\na"), (4, "a\na\nb b. c"), (5, None)]
    made = fingerprints(spark.createDataFrame(rows, "k int, t string"), ["k"], "t", "fp")
    fp = {r.k: F.array(*(F.lit(x) for x in r.fp)) for r in made.collect()}
    row = spark.range(1).select(
        (plus(fp[2], fp[3]) == fp[1]).alias("plus"), (minus(fp[1], fp[2]) == fp[3]).alias("minus"),
        (fp[1] == fp[4]).alias("order"), (fp[1] == fp[3]).alias("other"), (plus(fp[1], fp[5]) == fp[1]).alias("none"),
    ).first()
    assert tuple(row) == (True, True, True, False, True)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab .,\n\t é'l1\x1c漢", max_size=25), min_size=1, max_size=4))
def test_tokens(texts):
    exact = Tokenizer.from_file(BPE)
    tokens, edges = byte_bpe(BPE)(pa.array(texts))
    for k, text in enumerate(texts):
        assert list(tokens[edges[k] : edges[k + 1]]) == exact.encode(text, add_special_tokens=False).ids


def test_packing(odd_docs):
    rows = pack(odd_docs.where("doc_id > 1")).collect()
    exact = Tokenizer.from_file(BPE)
    parts, used = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        used[r.sequence_id].append((r.offset, r.length))
    for doc in odd_docs.where("doc_id > 1").collect():
        ids = np.array(exact.encode(doc.text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(parts[doc.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=80), st.lists(st.integers(0, 6000), max_size=30))
def test_elias_fano(values, asked):
    values = np.sort(np.array(values, np.uint64))
    held = EliasFano.of(values)
    assert (held.get(np.arange(len(values))) == values).all()
    assert (held.successor(np.array(asked, np.uint64)) == np.searchsorted(values, asked)).all()


def test_trie_on_a_memory_map(tmp_path):
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 40, (3000, 3)), axis=0)
    (tmp_path / "trie").write_bytes(Trie.of(40, grams, rng.normal(size=len(grams))).to_bytes())
    trie = Trie.open(np.memmap(tmp_path / "trie", dtype=np.uint8, mode="r"))
    asked = rng.integers(0, 40, (3000, 3))
    place = {tuple(g): k for k, g in enumerate(grams)}
    assert trie.find(asked).tolist() == [place.get(tuple(g), -1) for g in asked]


def test_model_is_a_distribution(make_docs):
    words = ["a", "b", "c"]
    texts = ["a b", "a b c", "b", "", "c a b", "a a"]
    model = ngram_lm.fit(make_docs(*((i, t, "en", "s") for i, t in enumerate(texts))))
    # behind "a" come a word, an unseen one, or the end
    asked = make_docs(*((i, f"a {w}", "en", "s") for i, w in enumerate([*words, "zz"])), (9, "a", "en", "s"))
    found = {r.doc_id: r.score for r in ngram_lm.score(asked, model).collect()}
    ends = {r.doc_id: r.score for r in ngram_lm.score(make_docs((0, "a", "en", "s")), model).collect()}
    assert all(v < 0 for v in found.values()) and abs(found[9] - ends[0]) < 1e-9


def test_risk_corrects_the_prior():
    p, u = np.array([2.0, 3.0]), np.array([2.0, -3.0, -2.0])
    plus_, minus_ = toxicity.risks(p, u, 0.3)
    assert plus_ == pytest.approx(0.3 * np.mean(np.log1p(np.exp(-p))))
    assert minus_ == pytest.approx(np.mean(np.log1p(np.exp(u))) - 0.3 * np.mean(np.log1p(np.exp(p))))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60), st.integers(1, 8))
def test_window_centres(hashes, least):
    def centres(a, b):
        if b - a < least:
            return []
        c = min(range(a, b), key=lambda k: (hashes[k], k))
        return [*centres(a, c), c, *centres(c + 1, b)]

    wide = np.array(hashes, np.uint64) << np.uint64(40)
    found = window_centres(wide, np.array([0]), np.array([len(hashes)]), least)
    assert found.tolist() == centres(0, len(hashes))


def test_common_stretches():
    x = np.arange(200, dtype=np.uint64)
    assert common_stretches(x, x[50:120], 46) == [(50, 120)]
    assert common_stretches(x, np.delete(x, [70])[40:130], 46) == [(40, 131)]
    assert common_stretches(x, x[50:80], 46) == []


def stretches_by_brute_force(there, least):
    n = len(there)
    enough = [
        (a, b)
        for a in range(n)
        for b in range(a + least, n + 1)
        if there[a] and there[b - 1] and 9 * sum(there[a:b]) >= 8 * (b - a)
    ]
    return [(a, b) for a, b in enough if not any((c, d) != (a, b) and c <= a and b <= d for c, d in enough)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([True] * 9 + [False]), max_size=50), st.integers(1, 20))
def test_common_stretches_by_brute_force(there, least):
    x = np.arange(len(there), dtype=np.uint64)
    assert common_stretches(x, x[np.array(there, bool)], least) == stretches_by_brute_force(there, least)


def test_common_stretches_with_one_word_changed():
    for size in range(50, 101):
        x = np.arange(size - 4, dtype=np.uint64)
        for word in range(size):
            left, right = max(0, word - 4), min(word + 1, size - 4)  # the shingles that have it
            begin, end = (right if left == 0 else 0), (left if right == size - 4 else size - 4)
            whole = [(begin, end)] if end - begin >= 46 else []
            found = common_stretches(x, np.delete(x, np.arange(left, right)), 46)
            assert found == whole, (size, word)


def test_passages_with_one_word_changed(make_docs):
    rows = []
    for word in (30, 40, 50):
        text = [f"w{word}.{k}" for k in range(80)]
        changed = text[:word] + ["other"] + text[word + 1 :]
        for doc, body in ((word, text), (word + 1, changed)):
            own = [f"d{doc}.{k}" for k in range(60)]
            rows.append((doc, " ".join(own + body + own[::-1]), "en", "s"))
    found = {(r.doc_id, r.like_id, r.start, r.end) for r in repeated_passages(make_docs(*rows)).collect()}
    pairs = [(w, w + 1) for w in (30, 40, 50)]
    assert found == {(a, b, 60, 140) for a, b in pairs} | {(b, a, 60, 140) for a, b in pairs}


def test_signatures_are_removed_once_met(spark, make_docs):
    body = " ".join(f"w{k}" for k in range(60))
    docs = make_docs((1, "a " + body, "en", "s"), (2, "b " + body, "en", "s"))
    with scratch_scope(spark) as folder:
        found = repeated_passages(docs)
        assert list(Path(folder).glob("*/passage_met"))
        assert not list(Path(folder).parent.rglob("passage_texts"))
        assert found.count() == 2


def test_passages_name_their_class(make_docs):
    shared = {p: " ".join(f"{p}.{k}" for k in range(60)) for p in "pq"}
    rows = []
    for doc in range(40):
        own = [" ".join(f"d{doc}.{part}.{k}" for k in range(30)) for part in range(3)]
        first = shared["p"] if doc < 30 else "none"
        second = shared["q"] if doc % 3 == 0 else "none"
        number = doc * 7 % 40  # ids in another order than the texts' hashes or this one
        rows.append((number, " ".join([own[0], first, own[1], second, own[2]]), "en", "s"))
    rows += [(100, "a b c d " * 20, "en", "s"), (101, "a b c d " * 20, "en", "s")]
    found = repeated_passages(make_docs(*rows)).collect()
    of = defaultdict(set)
    for r in found:
        of[r.passage].add((r.doc_id, r.start))
    p = {(d * 7 % 40, 30) for d in range(30)}
    q = {(d * 7 % 40, 120 if d < 30 else 61) for d in range(0, 40, 3)}
    assert sorted(map(sorted, of.values())) == sorted(map(sorted, [p, q, {(100, 0), (101, 0)}]))


@pytest.mark.parametrize("members", [512, 4])
def test_passages_of_common_sentences(make_docs, monkeypatch, members):
    """Each signature is in many texts; only the whole of three sentences is in two."""
    monkeypatch.setattr(windows, "MEMBERS", members)
    rows, wanted = [], set()
    for number in range(64):
        slots = number // 16, number // 4 % 4, number % 4
        body = " ".join(f"s{slot}.{which}.{k}" for slot, which in enumerate(slots) for k in range(20))
        for doc in (number, number + 64):
            own = [" ".join(f"d{doc}.{part}.{k}" for k in range(30)) for part in range(2)]
            rows.append((doc, " ".join([own[0], body, own[1]]), "en", "s"))
            wanted.add((doc, (doc + 64) % 128, 30, 90))
    found = repeated_passages(make_docs(*rows)).collect()
    assert {(r.doc_id, r.like_id, r.start, r.end) for r in found} == wanted


@pytest.mark.parametrize(
    "limits", [{}, {"MEMBERS": 4}, {"MEMBERS": 4, "APART": 0}, {"MEMBERS": 4, "APART": 0, "FEW": 1}]
)
def test_changed_passages_of_common_sentences(make_docs, monkeypatch, limits):
    """A changed word leaves no 50 words alike; the size of a group, and the way it goes, decide nothing."""
    for name, value in limits.items():
        monkeypatch.setattr(windows, name, value)
    rows, wanted = [], set()
    for number in range(64):
        slots = number // 16, number // 4 % 4, number % 4
        body = [f"s{slot}.{which}.{k}" for slot, which in enumerate(slots) for k in range(24)]
        for doc in (number, number + 64):
            own = [" ".join(f"d{doc}.{part}.{k}" for k in range(30)) for part in range(2)]
            changed = body if doc < 64 else [*body[:36], f"x{number}", *body[37:]]
            rows.append((doc, " ".join([own[0], *changed, own[1]]), "en", "s"))
            wanted.add((doc, (doc + 64) % 128, 30, 102))
    found = repeated_passages(make_docs(*rows)).collect()
    assert {(r.doc_id, r.like_id, r.start, r.end) for r in found} == wanted


def test_rare_values_meet():
    """Texts that share 41 places on either side have a rare value in common, whatever is held common."""
    rng = np.random.default_rng(7)
    for _ in range(200):
        x, y = (rng.integers(0, rng.integers(40, 400), 100).astype(np.uint32) for _ in range(2))
        common = rng.permutation(100).astype(np.uint32)[: rng.integers(0, 100)]
        if min(np.isin(x, y).sum(), np.isin(y, x).sum()) >= 41:
            assert len(np.intersect1d(rare_values(x, common, 41), rare_values(y, common, 41)))
    assert not len(rare_values(x[:40], common, 41))


@pytest.mark.parametrize("size", [1, 2, 3, 46])
def test_window_hashes(size):
    x = np.random.default_rng(5).integers(0, 2, 200).astype(np.uint32)
    h = window_hashes(x, size).tolist()
    plain = [tuple(x[k : k + size]) for k in range(200 - size + 1)]
    assert len(h) == len(plain) and len(set(h)) == len(set(plain)) == len(set(zip(h, plain)))
    assert not len(window_hashes(x[: size - 1], size))


def test_large_groups_give_rows_in_proportion(spark):
    """Texts that share 49 words and nothing else give no pairs; with 50 each has one with the shortest."""
    rng = np.random.default_rng(6)
    for shared, pairs in ((45, 0), (46, 199)):
        common = rng.integers(0, 2**32, shared)
        texts = [
            np.concatenate([rng.integers(0, 2**32, 50 + i), common, rng.integers(0, 2**32, 60)])
            for i in range(200)
        ]
        bodies = [(i, t.astype(np.uint32).tobytes()) for i, t in enumerate(texts)]
        members = [(7, i, 50 + i + 20, i) for i in range(200)]
        found = exact_pairs(
            spark.createDataFrame(members, "key bigint, id bigint, place int, label bigint"),
            spark.createDataFrame([(7,)], "key bigint"),
            spark.createDataFrame([(i, bytes(b)) for i, b in bodies], "id bigint, x binary"), 50,
        ).collect()
        assert len(found) == pairs and all(r.a == 0 < r.b for r in found)


@pytest.mark.parametrize("changed", [1, 2, 3])
def test_recall_of_changed_passages(make_docs, changed):
    """Passages of 100 words with some words changed anywhere, against the definition of a passage."""
    rng = np.random.default_rng(changed)
    rows, wanted = [], set()
    for doc in range(0, 200, 2):
        body = [f"{doc}.{k}" for k in range(100)]
        other = list(body)
        for k in rng.choice(100, changed, replace=False):
            other[k] = f"x{doc}.{k}"
        for d, part in ((doc, body), (doc + 1, other)):
            own = [f"d{d}.{k}" for k in range(40)]
            rows.append((d, " ".join(own + part + own[::-1]), "en", "s"))
        x, y = (np.array([hash(tuple(w[k : k + 5])) for k in range(96)]) for w in (body, other))
        if common_stretches(x, np.unique(y), 46) and common_stretches(y, np.unique(x), 46):
            wanted.add(doc)
    found = {(r.doc_id, r.like_id) for r in repeated_passages(make_docs(*rows)).collect()}
    assert all(a ^ 1 == b for a, b in found)
    hit = {a & ~1 for a, _ in found}
    assert hit <= wanted and len(hit) >= 0.9 * len(wanted) > 40


def test_quotes(spark):
    rows = [
        (1, 0, "a", "Hello all.\nShall we meet on Monday?\n\nBring the papers."),
        (1, 1, "b", "On Mon, a wrote:\n> Shall we  meet on monday?\n\nYes."),
        (1, 2, "c", "> Bring the papers.\nWhich papers?"),
        (1, 3, "a", ">> Shall we meet on Monday?\n> Yes.\nGood then."),
        (2, 0, "a", None),
        (2, 0, "a", None),
        (None, 3, "x", "> > q"),
        (3, None, None, "y"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = linked_conversations(frame).collect()
    assert Counter((r.conv_id, r.turn, r.text, r.reply_to, r.depth) for r in found) == Counter(
        [(1, 0, rows[0][3], None, 0), (1, 1, "Yes.", 0, 1), (1, 2, "Which papers?", 0, 1),
         (1, 3, "Good then.", 1, 2), (2, 0, "", None, 0), (2, 0, "", None, 0), (None, 3, "", None, 0),
         (3, None, "y", None, 0)]
    )
    assert linked_conversations(frame.limit(0)).collect() == []


def test_mix_is_near_its_targets(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"),
        F.when(F.col("id") % 10 < 6, F.lit("big")).when(F.col("id") % 10 < 9, F.lit("mid")).alias("source"),
    )
    rows = mix(docs).withColumn("source", F.col("_source")).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size")
    ).collect()
    assert all(abs(r.taken - r.target) <= 100 and r.target <= 3 * r["size"] for r in rows)
    assert sorted(mix(docs).collect()) == sorted(mix(docs.repartition(7)).collect())


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = corpus_pipeline.run(spark, sf_dir)
    exact = drop_exact(docs.where(F.col("text").rlike(r"\p{L}")))
    near = exact.join(
        jaccard_components(exact).where("doc_id = component_id").select("doc_id"), "doc_id", "left_semi"
    )
    copies = {r.doc_id: r.copies for r in mix(near).collect() if r.copies}
    found = pieces.where("start = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in found} == copies
