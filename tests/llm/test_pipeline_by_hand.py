"""The whole pipeline against plain Python, over the test documents with planted copies and odd rows."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from topicloom.session import saved

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def planted(rows):
    """The documents with copies, near copies, texts just below the line, and rows of nothing."""
    rng = random.Random(8)
    out = list(rows)
    for k, row in enumerate(rows[:60]):
        w = WORD.findall(row["text"])
        if len(w) < 100:
            continue
        near, far = list(w), list(w)
        near[len(w) // 2] = "changed"
        for at in rng.sample(range(len(w)), len(w) // 4):
            far[at] = f"other{at}"
        for number, text in ((1000 + k, row["text"]), (2000 + k, " ".join(near)), (3000 + k, " ".join(far))):
            out.append(row | {"doc_id": number, "text": text, "lang": None})
    for number, text in ((5000, None), (5001, ""), (5002, "12 34 %"), (5003, "one two"), (5004, "one two")):
        out.append({"doc_id": number, "text": text, "lang": None, "source": None, "n_chars": None})
    return out


def near_groups(texts):
    sets = {}
    for k, text in texts.items():
        w = WORD.findall(text.lower())
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    group = {k: {k} for k in texts}
    for a, b in combinations(sorted(texts), 2):
        common = len(sets[a] & sets[b])
        if group[a] is not group[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            group[a] |= group[b]
            for k in group[b]:
                group[k] = group[a]
    return {frozenset(g) for g in group.values()}


def source_targets(size):
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, target = float(sum(size.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * size[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: 3.0 * size[s] for s in over}
        left -= sum(3.0 * size[s] for s in over)
        open_ -= over
    return target


def test_stages(spark, tmp_path):
    rows = planted(pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist())
    schema = pq.read_schema("/root/testdata/sf0.001/documents.parquet")
    pq.write_table(pa.Table.from_pylist(rows, schema), str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == schema.names
        kept.append([r.asDict() for r in docs.collect()])
    language, exact, near, mixed = kept

    has_letter = {r["doc_id"]: r["text"] for r in rows if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"]: r["text"] for r in language} == has_letter
    given = {r["doc_id"]: r["lang"] for r in rows if r["lang"]}
    assert all(r["lang"] and r["lang"] == given.get(r["doc_id"], r["lang"]) for r in language)

    first = {}
    for number, text in sorted(has_letter.items()):
        first.setdefault(text, number)
    assert sorted(r["doc_id"] for r in exact) == sorted(first.values())

    groups = near_groups({number: text for text, number in first.items()})
    stay = {r["doc_id"] for r in near}
    assert len(near) == len(stay) == len(groups) and all(len(g & stay) == 1 for g in groups)
    assert any(len(g) > 1 for g in groups) and any(k >= 3000 for k in stay)

    words = {r["doc_id"]: len(WORD.findall(r["text"])) for r in near}
    source = {r["doc_id"]: r["source"] for r in near}
    size, taken = Counter(), Counter()
    for number, n in words.items():
        size[source[number]] += n
    copies = Counter(r["doc_id"] for r in mixed)
    for number, times in copies.items():
        assert times <= 3
        taken[source[number]] += times * words[number]
    longest = defaultdict(int)
    for number, n in words.items():
        longest[source[number]] = max(longest[source[number]], n)
    for s, target in source_targets(size).items():
        assert abs(taken[s] - target) <= 2 * longest[s] + 1, s

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    text = {r["doc_id"]: r["text"] for r in near}
    length = {k: len(encode(text[k], add_special_tokens=False).ids) + 1 for k in copies}
    total, of_sequence = Counter(), defaultdict(list)
    for p in pieces:
        assert p.doc_tokens == length[p.doc_id]
        total[p.doc_id] += p.length
        of_sequence[p.sequence_id].append((p.offset, p.length))
    assert total == {k: times * length[k] for k, times in copies.items()}
    for places in of_sequence.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= 2048
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.agg(F.sum("length")).first()[0] == sum(total.values())
