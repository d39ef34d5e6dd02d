from collections import defaultdict
import hashlib


from sieveline.llm import exact_dedup as dedup
from rows import clashing, empty_docs, lowered, odd_rows


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[lowered(text)].append(doc_id)
    out, order = [], lambda i: (i is not None, i or 0)
    for text, ids in groups.items():
        keep, left = max(ids, key=order), True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and left, hashlib.sha256(text.encode()).hexdigest()))
            left = left and i != keep
    return sorted(out, key=str)


def test_against_brute_force(spark):
    found = [tuple(r) for r in dedup.exact_dedup(clashing(spark)).collect()]
    assert sorted(found, key=str) == brute(odd_rows())


def test_empty(spark):
    assert dedup.exact_dedup(empty_docs(spark)).count() == 0


def test_many_copies_and_single_rows(spark):
    rows = [(i, "the same" if i % 3 == 0 else f"text {i}", None, None, None) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted([tuple(r) for r in dedup.exact_dedup(df).collect()], key=str) == brute(rows)


def test_filter_lets_single_rows_pass(spark):
    rows = dedup.fingerprints(spark.range(2000).selectExpr("id doc_id", "string(id) text"), "doc_id", "text")
    twice = dedup.repeat_filter(rows, 8)
    bits = sum(bin(w & (1 << 64) - 1).count("1") for r in twice.collect() for w in r["__words"])
    assert bits < 1200  # of 32768: two rows rarely meet


def test_without_copies_keeps_columns(spark):
    kept = dedup.without_copies(clashing(spark))
    assert kept.columns == clashing(spark).columns
    texts = [lowered(r.text) for r in kept.select("doc_id", "text").distinct().collect()]
    assert len(texts) == len(set(texts)) == len({lowered(r[1]) for r in odd_rows()})
