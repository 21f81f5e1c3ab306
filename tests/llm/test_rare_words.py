"""Pairs of words have their own probabilities, however many words have a number."""

import math
from collections import Counter

import pytest

from topicloom.llm import ngram_lm

TRAIN = ["a b c a b", "a b d", "zz a b", "", "q", "a d d d", None, "b a c", "x y x y x y", "x y a"]
ASKED = [*TRAIN, "x y", "x q", "y x", "new words here", "a new b", "q a q", "x zz new"]


def plain_scores(train, asked):
    """The documented formula."""
    texts = [["<s>", *(t or "").split(), "</s>"] for t in train]
    single = Counter(w for t in texts for w in t[1:])
    pairs = Counter(p for t in texts for p in zip(t[:-1], t[1:], strict=True))
    context, followers = Counter(), Counter(v for v, _ in pairs)
    for (v, _), n in pairs.items():
        context[v] += n
    tokens, once = sum(single.values()), sum(n == 1 for n in pairs.values())
    d = min(0.95, max(0.05, once / (once + 2 * sum(n == 2 for n in pairs.values()))))
    out = []
    for t in asked:
        row, total = ["<s>", *(t or "").split(), "</s>"], 0
        for v, w in zip(row[:-1], row[1:], strict=True):
            p = (single[w] + 0.5) / (tokens + 0.5 * (len(single) + 1))
            if context[v]:
                p = max(pairs[v, w] - d, 0) / context[v] + d * followers[v] / context[v] * p
            total += math.log10(p)
        out.append(total)
    return out


@pytest.mark.parametrize(("known", "error"), [(0, 1e-6), (3, 0.02), (5, 0.02), (1 << 18, 0.02)])
def test_rare_pairs_have_their_own_probability(make_docs, monkeypatch, known, error):
    monkeypatch.setattr(ngram_lm, "KNOWN", known)
    train = make_docs(*((k, t, "en", "s") for k, t in enumerate(TRAIN)))
    asked = make_docs(*((k, t, "en", "s") for k, t in enumerate(ASKED)))
    model = ngram_lm.fit(train)
    found = {r.doc_id: r for r in ngram_lm.score(asked, model).collect()}
    words = Counter(w for t in TRAIN for w in (t or "").split())
    assert len(model.vocabulary.hashes) <= known
    for k, expected in enumerate(plain_scores(TRAIN, ASKED)):
        row = (ASKED[k] or "").split()
        assert found[k].score == pytest.approx(expected, abs=error * (len(row) + 1))
        assert (found[k].n_tokens, found[k].n_known) == (len(row) + 1, sum(w in words for w in row) + 1)
