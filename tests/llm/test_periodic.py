"""Runs against brute force over all periods, and the query's digests against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from rows import WORDS, clashing, empty_docs, odd_docs
from sieveline.llm import periodic, queries


def brute_runs(words):
    """(start, length, period) by comparing all words with those a period before."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= 3 * q and j - i + q >= 6 and not any(
                all(words[x] == words[x + p] for x in range(i, j + q - p)) for p in range(1, q) if q % p == 0
            ):
                found.append((i, j - i + q, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def without(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words or doc_id is None:
        return words
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]


def texts(seed):
    """Random texts over few words, with nested repetitions of many periods and lengths."""
    r = random.Random(seed)
    for _ in range(120):
        words = [r.choice("abc"[: r.randint(1, 3)]) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 4)):
            i = r.randint(0, len(words))
            block = words[i : i + r.randint(1, 40)] or ["z"]
            words = words[:i] + block * r.randint(2, 7) + words[i + r.randint(0, 3) :]
        yield words[: r.randint(0, 400)]


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_texts(seed):
    every = list(texts(seed))
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in every])])
    symbols = {w: np.uint64(i * 7919 + 13) for i, w in enumerate(sorted({w for t in every for w in t}))}
    found = periodic.runs_of_texts(np.array([symbols[w] for t in every for w in t], np.uint64), offsets)
    got = {}
    for text, *run in zip(*map(list, found)):
        got.setdefault(int(text), []).append(tuple(map(int, run)))
    assert any(got.values())
    for i, words in enumerate(every):
        assert got.get(i, []) == brute_runs(words), words


def test_chosen_positions_are_consistent_and_dense():
    r = np.random.default_rng(3)
    names = r.integers(0, 1 << 63, 4000).astype(np.uint64)
    names[2000:3000] = names[500:1500]
    chosen = periodic.synchronising_set(names, 16, np.zeros(len(names), bool))
    first, second = (set(chosen[(chosen >= a) & (chosen < a + 1000 - 32)] - a) for a in (500, 2000))
    assert first == second and np.diff(chosen).max() <= 16 and len(chosen) < len(names) / 4


def test_long_periods_and_long_runs(spark):
    r = random.Random(5)
    block = [f"w{r.randint(0, 10**6)}" for _ in range(3000)]
    rows = [(1, " ".join(block * 4 + block[:100])), (2, "a " * 50_000), (3, " ".join(["x", "x", "y"] * 5000 + block))]
    got = {x.doc_id: x for x in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 12100, 3000)] and got[1].collapsed == " ".join(block)
    assert [tuple(x) for x in got[2].runs] == [(0, 50_000, 1)] and got[2].collapsed == "a"
    assert [tuple(x) for x in got[3].runs] == [(0, 15_000, 3)] and got[3].n_words == 18_000


def test_odd_rows(spark):
    docs = odd_docs(spark).union(spark.createDataFrame([(20, "A a A a A a A a", "en", "a", 1), (21, "x\tx\nx  x x x", "en", "a", 1)], docs_schema(spark)))
    got = periodic.periodic_runs(docs)
    assert got.columns == [*docs.columns, "n_words", "runs", "collapsed"]
    for r in got.collect():
        words = WORDS.findall(r.text or "")
        runs = brute_runs(words) if len(words) < 1000 else []
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(words) and r.collapsed == without(words, runs)


def docs_schema(spark):
    return odd_docs(spark).schema


def test_clashing_names_and_empty_tables(spark):
    got = periodic.periodic_runs(clashing(spark).withColumns({"runs": F.lit(1), "collapsed": F.lit("x")}))
    assert got.filter("n_words = 40").first().collapsed.startswith("w0 w1 ")
    assert periodic.periodic_runs(empty_docs(spark)).count() == 0


def test_query_against_plain_python(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op13_periodic_runs"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        words = planted(r.doc_id, WORDS.findall(docs[r.doc_id] or ""))
        if len(words) > 800:
            continue
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(without(words, runs).encode()).hexdigest()
