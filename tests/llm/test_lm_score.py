import math
from collections import Counter

import pytest

from sieveline.llm import lm_score
from rows import clashing, empty_docs, odd_docs, odd_rows, words


def brute(rows, order):
    grams = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    texts = [words(r[1]) for r in rows]
    counts = Counter(g for w in texts for k in range(1, order + 1) for g in grams(w, k))
    total = sum(map(len, texts))
    out = []
    for (doc_id, *_), w in zip(rows, texts):
        own = Counter(g for k in range(1, order + 1) for g in grams(w, k))
        left = lambda g: counts[g] - own[g]

        def s(g):
            if len(g) == 1:
                return math.log(max(left(g), 0.5) / max(total - len(w), 1))
            if left(g) > 0 and left(g[:-1]) > 0:
                return math.log(left(g) / left(g[:-1]))
            return math.log(0.4) + s(g[1:])

        value = sum(s(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w)))
        out.append((doc_id, len(w), round(value, 3), round(value / len(w), 6) if w else None))
    return sorted(out, key=str)


def found(df, order):
    rows = lm_score.lm_scores(df, order=order).collect()
    return sorted([(r.doc_id, r.n_words, round(r.log_score, 3), None if r.score_per_word is None else round(r.score_per_word, 6)) for r in rows], key=str)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(spark, order):
    assert found(odd_docs(spark), order) == brute(odd_rows(), order)


def test_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CHUNK_CHARS", 2000)
    monkeypatch.setattr(lm_score, "PART_GRAMS", 500)
    assert found(clashing(spark), 2) == brute(odd_rows(), 2)


def test_empty(spark):
    assert lm_score.lm_scores(empty_docs(spark)).count() == 0
