import random

import pyarrow as pa
from pyspark.sql import functions as F

from sieveline import sizing
from sieveline.llm import decontaminate
from rows import clashing, empty_docs, odd_docs, odd_rows, sentence, words

ITEMS = "item_id long, text string"


def grams(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(docs, items):
    sets = {}
    for i, text in items:
        if words(text):
            sets.setdefault(frozenset(grams(text, min(5, len(words(text))))), []).append(i)
    found = []
    for d, text, *_ in docs:
        g = set().union(*[grams(text, k) for k in range(1, 6)])
        found += [(d, min(ids), len(ids), len(s), len(s & g)) for s, ids in sets.items() if 4 * len(s & g) >= 3 * len(s)]
    return sorted(found, key=str)


def items():
    return [(1, sentence(20, 5)), (2, sentence(20, 5).upper()), (3, None), (4, ""), (5, "w1 w2 w3 w4"), (6, sentence(5, 100)),
            (7, sentence(12, 29_990)), (10, "TINY"), (11, "b c"), (12, "c b"), (13, "w39"), (14, "w4 w3"), (8, sentence(30, 20) + " z z z z z z"), (9, "not there at all in any text")]


def test_against_brute_force(spark):
    found = decontaminate.find_leaks(clashing(spark), spark.createDataFrame(items(), ITEMS))
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute(odd_rows(), items())


def test_items_in_changed_and_scattered_form(spark):
    rng = random.Random(7)
    tests = [(i, " ".join(f"q{rng.randrange(4000)}" for _ in range(rng.choice([8, 15, 40, 200])))) for i in range(120)]
    docs = []
    for i in range(300):
        w = [f"p{rng.randrange(9000)}" for _ in range(rng.choice([30, 400, 3000]))]
        item = rng.choice(tests)[1].split()
        kind = i % 4
        if kind == 1:
            item[rng.randrange(len(item))] = "changed"
        if kind == 2:
            half = len(item) // 2
            w[5:5] = item[:half]
            item = item[half:]
        if kind < 3:
            at = rng.randrange(len(w))
            w[at:at] = item
        docs.append((i, " ".join(w), None, None, None))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    found = decontaminate.find_leaks(df, spark.createDataFrame(tests, ITEMS))
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute(docs, tests)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    found = decontaminate.find_leaks(odd_docs(spark), spark.createDataFrame(items(), ITEMS))
    assert sorted([tuple(r) for r in found.collect()], key=str) == brute(odd_rows(), items())


def test_clean_documents_stay(spark):
    kept = decontaminate.decontaminated(clashing(spark), spark.createDataFrame(items(), ITEMS))
    bad = {r[0] for r in brute(odd_rows(), items())}
    assert kept.columns == clashing(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in odd_rows() if r[0] not in bad)


def test_empty(spark):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.find_leaks(odd_docs(spark), none).count() == 0
    assert decontaminate.find_leaks(empty_docs(spark), spark.createDataFrame(items(), ITEMS)).count() == 0


def test_short_items(spark):
    tests = spark.createDataFrame([(1, "alpha beta"), (2, "Beta  gamma DELTA"), (3, "beta"), (4, "betas"), (5, " ")], ITEMS)
    docs = spark.createDataFrame([(1, "x alpha\nbeta gamma delta y z"), (2, "alpha"), (3, "beta alpha"), (4, None)], "doc_id long, text string")
    found = decontaminate.find_leaks(docs, tests)
    assert sorted((r.doc_id, r.item_id, r.shared) for r in found.collect()) == [(1, 1, 1), (1, 2, 1), (1, 3, 1), (3, 3, 1)]


def test_members_of_items(spark):
    tests = spark.createDataFrame([*items(), (20, "tiny"), (21, None)], ITEMS)
    classes = {}
    for i, text in [*items(), (20, "tiny")]:
        if words(text):
            classes.setdefault(frozenset(grams(text, min(5, len(words(text))))), []).append(i)
    wanted = sorted((min(ids), i) for ids in classes.values() for i in ids)
    assert sorted(tuple(r) for r in decontaminate.item_members(tests).collect()) == wanted


def test_candidates_are_fewer_than_documents_that_share_a_shingle():
    import numpy as np

    from sieveline.llm.words import shingles

    rng = np.random.default_rng(3)
    rows, sets = [], []
    for i in range(200):
        w = rng.integers(0, 1 << 63, 104, dtype=np.uint64)
        sets.append(w)
        rows.append((i, 5, np.unique(shingles(w, 5)).tobytes()))
    index = decontaminate.Items(rows)
    shared = whole = halves = 0
    for w in sets:
        around = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
        shared += len(index.candidates(shingles(np.concatenate([around(300), w[50:55], around(300)]), 5)))
        # 76 of 100 shingles in a run, and in two parts far from each other.
        whole += len(index.found_in(np.concatenate([around(300), w[:80], around(300)]), 75))
        halves += len(index.found_in(np.concatenate([around(300), w[:50], around(900), w[50:], around(300)]), 75))
    assert shared < 60 and whole == 200 and halves >= 196


def test_texts_go_to_python_in_small_batches(spark):
    spark.conf.unset(sizing.BATCH_SETTING)
    docs = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("word "), 1400), F.col("id")).alias("text"))
    found = decontaminate.find_leaks(docs, spark.createDataFrame([(1, "word word word word word 7")], ITEMS))
    assert [r.doc_id for r in found.collect()] == [7]

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"])

    sent = [r.size for r in docs.mapInArrow(sizes, "size long").collect()]
    assert sum(sent) > 2 * sizing.BATCH_BYTES and max(sent) < 1.1 * sizing.BATCH_BYTES
    # A size that the session was given stays.
    spark.conf.set(sizing.BATCH_SETTING, "32m")
    decontaminate.find_leaks(docs, spark.createDataFrame([], ITEMS))
    assert spark.conf.get(sizing.BATCH_SETTING) == "32m"
    spark.conf.unset(sizing.BATCH_SETTING)


def test_names_of_items_need_no_python_workers(spark, capsys):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string").localCheckpoint()
    items = spark.sql("select timestamp'2020-01-02 03:04:05' as item_id, 'b c' as text")
    found = decontaminate.find_leaks(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), items)
    found.explain()
    assert "ExistingRDD" not in capsys.readouterr().out
    assert decontaminate.find_leaks(docs, items).first().item_id == items.first().item_id
