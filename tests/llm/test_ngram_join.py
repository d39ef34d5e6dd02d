import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from sieveline.llm import components, ngram_join, words as w
from rows import clashing, empty_docs, odd_rows, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    x = words(text)
    return {tuple(x[i : i + 5]) for i in range(len(x) - 4)} if len(x) >= 5 else {tuple(x)} - {()}


def brute(rows):
    sets = [(r[0], grams(r[1])) for r in rows]
    links = [
        (a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
        if a is not None and b is not None and x and 100 * len(x & y) >= 75 * len(x | y)
    ]
    lead = dict(components.forest(links))
    return sorted(((i, len(s), lead.get(i, i)) for i, s in sets), key=str)


def found(df):
    return sorted([tuple(r) for r in ngram_join.jaccard_components(df).collect()], key=str)


def test_against_brute_force(spark):
    assert found(clashing(spark)) == brute(odd_rows())


def copies(rng, groups, most):
    rows = []
    for g in range(groups):
        base = [f"{g % 7}w{rng.randrange(3000)}" for _ in range(rng.choice([4, 6, 9, 30, 150, 700]))]
        for _ in range(rng.randrange(1, most)):
            x = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5, len(x) // 25])):
                x[rng.randrange(len(x))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(x), None, None, None))
    return rows


def test_near_copies(spark):
    rows = copies(random.Random(3), 60, 9)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_large_groups_of_near_copies(spark, monkeypatch):
    # Clusters in blocks: pairs with the first document at once, the rest in the later round.
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", 7)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    monkeypatch.setattr(ngram_join, "CLUSTER_PAIRS", 20)
    rows = copies(random.Random(5), 6, 60)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_one_of_each(spark):
    kept = ngram_join.one_of_each(clashing(spark))
    assert kept.columns == clashing(spark).columns
    stays = {i for i, _, c in brute(odd_rows()) if i == c}
    assert {r.doc_id for r in kept.collect()} == stays


def repeated_ids():
    t = [" ".join(f"{x}{i}" for i in range(40)) for x in "abcde"]
    # An id with two texts, with a text and none, rows that repeat id and text, three texts in a chain.
    return [
        (5, t[0]), (7, t[0]), (7, t[1]), (9, t[1]), (12, t[1] + " tail"), (20, t[2]), (20, None), (18, t[2]),
        (30, t[3]), (30, t[3]), (31, t[3]), (40, ""), (40, ""), (41, t[4]), (41, t[4].upper()),
    ]


def test_ids_with_several_texts_are_one_node(spark):
    rows = repeated_ids()
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_no_text_vanishes_and_no_copy_stays(spark):
    kept = ngram_join.one_of_each(spark.createDataFrame(repeated_ids(), "doc_id long, text string")).collect()
    first = [(r.doc_id, next(iter(words(r.text)), "")) for r in kept]
    assert sorted(first) == [(5, "a0"), (7, "b0"), (18, "c0"), (20, ""), (30, "d0"), (40, ""), (41, "e0")]


def test_empty(spark):
    assert ngram_join.jaccard_components(empty_docs(spark)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(5001, 7000)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = dict(components.forest(links))
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want.get(x, x) for x in nodes}


def test_word_hashes_of_long_and_odd_texts(monkeypatch):
    texts = ["", None, " a  b c ", "x" * 5000, ("ab " * 3000) + "y" * 4000 + "\tEnd", "É é\x0bÉ", "a b"]
    whole = w.word_hashes(pa.array(texts))
    monkeypatch.setattr(w, "SLICE_BYTES", 64)
    sliced = w.word_hashes(pa.array(texts))
    assert np.array_equal(whole[0], sliced[0]) and np.array_equal(whole[1], sliced[1])
    seen = {}
    for text, a, b in zip(texts, whole[1][:-1], whole[1][1:]):
        assert b - a == len(words(text))
        for word, h in zip(words(text), whole[0][a:b]):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_fine_counts_bound_the_difference():
    from sieveline.llm.ngram_join import fine_counts, fine_distance

    draw = np.random.default_rng(5)
    hashes = lambda n: np.unique(draw.integers(0, 2**64, n, np.uint64))
    assert fine_counts(hashes(256)) == b"" and fine_distance(b"", fine_counts(hashes(999))) == 0
    for n in (257, 300, 512, 513, 1000, 5000):
        base = hashes(n)
        assert len(base) / 2 <= 2 * len(fine_counts(base)) < len(base)
        for gone, more in ((0, 0), (3, 40), (n // 5, n // 5), (0, 2 * n)):
            other = np.unique(np.concatenate([base[gone:], hashes(more)]))
            apart = len(np.setxor1d(base, other))
            found = fine_distance(fine_counts(base), fine_counts(other))
            assert abs(len(base) - len(other)) <= found <= apart
        # Sets without a common element are told apart by far.
        assert fine_distance(fine_counts(base), fine_counts(hashes(n))) > n * 2 // 3


def blocks_of(sets, order):
    """The blocks of one group: a document in each, with the first ``p`` elements of its ``order``."""
    rows = []
    for u in sets:
        own = np.array(order(u), np.uint64)[: ngram_join.prefix_length(len(u), 75)]
        values = [np.frombuffer(ngram_join.set_key(u), "V16"), np.array([len(u)], np.int32), own.astype(np.uint32)]
        values += [np.zeros(len(own), np.int32), np.arange(len(own), dtype=np.int32)]
        rows.append([v.tobytes() for v in values])
    return pd.DataFrame(rows, columns=["keys", "sizes", "tokens", "owners", "places"])


def test_runs_keep_only_who_may_be_linked():
    base = np.arange(1000, 1100, dtype=np.uint64)
    near = np.arange(1001, 1101, dtype=np.uint64)
    # Two that are too long for the others or hold the shared element too late, in runs of more than two.
    long = np.concatenate([np.arange(1001, 1005), np.arange(5000, 5300)]).astype(np.uint64)
    late = np.concatenate([np.arange(900, 921), np.arange(1001, 1005), np.arange(7000, 7075)]).astype(np.uint64)
    met = ngram_join.meetings(blocks_of([base, near, long, late], list), 75)
    assert set(met["key"]) == {ngram_join.set_key(base), ngram_join.set_key(near)}
    # Alone they meet nobody.
    assert not len(ngram_join.meetings(blocks_of([base, long, late], list), 75))


def test_runs_against_all_pairs(monkeypatch):
    draw = np.random.default_rng(9)
    n, place = draw.integers(1, 60, 3000), draw.integers(0, 8, 3000)
    length = np.array([1, 2, 3, 9, 64, 65, 200] * 9)
    length = length[np.cumsum(length) <= 3000]
    first = np.cumsum(length) - length
    total = length.sum()
    got = ngram_join.with_partner(n[:total], place[:total], first, length, 75)
    for f, k in zip(first, length):
        for x in range(f, f + k):
            some = any(
                x != y and 100 * min(n[x], n[y]) >= 75 * max(n[x], n[y])
                and min(n[x] - place[x], n[y] - place[y]) >= -(-75 * (n[x] + n[y]) // 175)
                for y in range(f, f + k)
            )
            assert got[x] == (some or k > 64)


def test_order_tells_close_counts_apart(spark):
    """An element of some twenty documents comes after those of one, though its counter holds a hundred others."""
    counts = np.full(1 << ngram_join.SKETCH_BITS, 100, np.uint32)
    counts[5], counts[6], counts[7] = 120, 80, 100_000
    blocks = [counts[i : i + ngram_join.SKETCH_BLOCK].tobytes() for i in range(0, len(counts), ngram_join.SKETCH_BLOCK)]
    ranks = ngram_join.frequency_ranks(spark.createDataFrame(list(enumerate(blocks)), "block int, counts binary"))
    assert ranks[6] < ranks[0] < ranks[5] < ranks[7] and ranks.dtype == np.uint16


def test_small_groups_are_joined_without_a_broadcast(spark):
    from sieveline.llm.common import HOT_ROWS, join_groups

    rows = spark.createDataFrame([(i % 9, i) for i in range(100)], "k long, v long")
    groups = rows.groupBy("k").agg({"v": "count"}).withColumnRenamed("count(v)", "n")
    found = join_groups(rows, groups, "k", "n", 100, HOT_ROWS)
    assert "Broadcast" not in found._jdf.queryExecution().toString()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, join_groups(rows, groups, "k", "n", 100).collect()))
