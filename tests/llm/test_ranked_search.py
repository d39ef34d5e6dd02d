"""Ranks against scores of all pairs in plain Python, and the bounds that prune."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rows import clashing, empty_docs, lowered, odd_rows
from sieveline.llm import ranked_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string"


def brute(docs, items, k=10):
    """{(item id, terms): [(doc id, score)]}, best first."""
    bags = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = {}
    for item, text in items:
        terms = Counter(TERM.findall(lowered(text)))
        found = []
        for i, b in bags:
            m = 100 - 75 + (75 * sum(b.values()) * n) // total
            score = sum(c * weight[t] * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m)) for t, c in terms.items() if t in b)
            if score > 0:
                found.append((i, score))
        found.sort(key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        if found:
            out[item, frozenset(terms.items())] = found[:k]
    return out


def random_rows(n, seed, longest=60):
    r = random.Random(seed)
    vocabulary = [f"{r.choice('äbc')}{i}" for i in range(300)]
    word = lambda: vocabulary[min(299, int(r.paretovariate(0.7)) - 1)]
    return [(i, r.choice([" ", ", "]).join(word() for _ in range(r.randint(0, longest)))) for i in range(n)]


def ranks(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r.item_id, {})[r.rank] = (r.doc_id, r.score)
    return {i: [found[j] for j in range(1, len(found) + 1)] for i, found in rows.items()}


@pytest.mark.parametrize("block_bytes", [search.BLOCK_BYTES, 3000])
def test_against_all_pairs(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(search, "BUCKET", 37)
    docs = random_rows(900, 1) + [(900 + i, "same text of many copies b3 c7") for i in range(300)]
    items = random_rows(40, 2, 25) + [(100, docs[5][1]), (101, None), (102, " -- "), (103, "unheard of"), (104, "same copies")]
    got = ranks(search.ranked_search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), block_bytes=block_bytes))
    assert got == {i: found for (i, _), found in brute(docs, items).items()}


def test_bounds_prune():
    """Most documents that share a term are not scored, none that belongs to the best is lost."""
    r = np.random.default_rng(4)
    size, n = 400, 2000
    weights = r.integers(1, 9000, size)
    rows = [np.sort(r.choice(size, r.integers(1, 40), replace=False)) for _ in range(n)]
    impacts = [r.integers(100_000, 1_000_000, len(t)) for t in rows]
    lengths = np.array([math.sqrt((weights[t] * x.astype(float) ** 2).sum()) for t, x in zip(rows, impacts)])
    order = np.argsort(-lengths)
    bounds = np.concatenate([[0], np.cumsum([len(rows[i]) for i in order])])
    terms, values = (np.concatenate([x[i] for i in order]) for x in (rows, impacts))
    bucket = search.Bucket(None, lengths[order], terms, values, bounds, size)
    looked = shared = 0
    for _ in range(50):
        t = np.sort(r.choice(size, 12, replace=False))
        query = search.Query(t, r.integers(1, 3, 12), weights)
        dense = np.zeros(size, np.int64)
        dense[query.terms] = query.weights
        every = bucket.scores(np.arange(n), dense)
        threshold = int(np.sort(every)[-10])
        survivors = bucket.survivors(query, threshold)
        looked, shared = looked + len(survivors), shared + int((every > 0).sum())
        assert set(np.flatnonzero(every >= threshold)) <= set(survivors)
    assert looked < shared / 2
    assert not len(bucket.survivors(query, int(lengths.max() * query.rest[0] * 1.01)))


def test_files_of_a_task_in_any_order(spark):
    """A task reads several sorted files, one after another: the longest vector need not come first."""
    weights = np.array([100, 100], np.int64)
    rows = [(i, 10.0 * x, [0], [x]) for i, x in [(1, 9), (2, 7), (3, 800), (4, 6), (5, 900), (6, 1)]]
    vectors = spark.createDataFrame(rows, "doc_id long, length double, terms array<int>, impacts array<bigint>").coalesce(1)
    query = search.Query(np.array([0]), np.array([1]), weights)
    found = search.search_vectors(vectors, [query], [50_000], 2, 2).collect()
    assert sorted((r.doc_id, r.score) for r in found) == [(3, 80_000), (5, 90_000)]


def test_odd_rows(spark):
    docs = [(r[0], r[1]) for r in odd_rows()]
    items = [(1, "W3 w4 w5"), (1, "tiny"), (1, "tiny"), (None, "straße"), (2, ""), (3, None), (4, "a a b d")]
    got = search.ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    wanted = [(i, rank, d, s) for (i, _), found in brute(docs, items).items() for rank, (d, s) in enumerate(found, 1)]
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)


def test_clashing_names_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "w3 w4")], ITEMS).withColumns({"doc_id": F.lit(5), "score": F.lit(5), "terms": F.lit("x")})
    wanted = search.ranked_search(spark.createDataFrame([(r[0], r[1]) for r in odd_rows()], DOCS), items).collect()
    assert wanted and search.ranked_search(clashing(spark), items.withColumnRenamed("item_id", "number"), item_id="number").collect() == wanted
    assert search.ranked_search(empty_docs(spark), items).count() == 0
    assert search.ranked_search(clashing(spark), items.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], DOCS)
    assert search.ranked_search(blank, items).count() == 0


def test_ids_of_text(spark):
    docs = [(f"d{i}", t) for i, t in random_rows(50, 3)]
    got = search.ranked_search(spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame([(1, "b1 c0 ä2")], ITEMS))
    assert [r.rank for r in got.orderBy("rank").collect()] == list(range(1, got.count() + 1)) and got.schema["doc_id"].dataType.simpleString() == "string"
