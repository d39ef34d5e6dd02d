import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import language
from rows import clashing, empty_docs, odd_docs, odd_rows

SF = "/root/testdata/sf0.01"


def brute_surprisal(train, text, order):
    """Interpolated Kneser-Ney over plain dictionaries: -log p of every character but the first."""
    grams = [{} for _ in range(order + 1)]
    for t in train:
        for i in range(len(t)):
            for k in range(1, order + 1):
                if i + 1 >= k:
                    g = t[i + 1 - k : i + 1]
                    grams[k][g] = grams[k].get(g, 0) + 1
    counts = [None] * (order + 1)
    counts[order] = grams[order]
    for k in range(1, order):
        counts[k] = {}
        for g in grams[k + 1]:
            counts[k][g[1:]] = counts[k].get(g[1:], 0) + 1

    def prob(g, k):
        lower = prob(g[1:], k - 1) if k > 1 else 1.0 / (len(counts[1]) + 1)
        c = counts[k]
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5
        total = sum(v for x, v in c.items() if x[:-1] == g[:-1])
        kinds = sum(1 for x in c if x[:-1] == g[:-1])
        if not total:
            return lower
        return max(c.get(g, 0) - d, 0) / total + d * kinds / total * lower

    return [-math.log(prob(text[max(0, i + 1 - order) : i + 1], min(order, i + 1))) for i in range(1, len(text))]


def test_model_against_dictionaries():
    rng = random.Random(2)
    train = [" " + "".join(rng.choice("aab c") for _ in range(60)).replace("  ", " ") + " " for _ in range(5)]
    texts = [" abc aab ", " zab ", " c "]
    codes = lambda t: np.array([ord(c) for c in t], np.uint32)
    model = language.train([codes(t) for t in train], 3)
    sums = language.Scorer([model], 3).totals([codes(t) for t in texts])[:, 0, 0]
    assert sums == pytest.approx([sum(brute_surprisal(train, t, 3)) for t in texts])
    # Given a context, the probabilities of all characters, an unseen one included, make 1.
    grams = lambda t: [h[-1:] for h in language.gram_hashes(codes(t), 3)]
    context = [np.zeros(1, np.uint64)] + [h[-1:] for h in language.gram_hashes(codes(" a"), 2)]
    p = [math.exp(-language.surprisal(model, grams(" a" + c), context)[0]) for c in "abc z"]
    assert sum(p) == pytest.approx(1)


def test_pieces_of_long_texts_add_up(monkeypatch):
    codes = language.codes_of("the quick brown fox jumps over the lazy dog " * 50)
    scorer = language.Scorer([language.train([codes])])
    whole = scorer.totals([codes, codes[:9]])
    monkeypatch.setattr(language, "PIECE", 100)
    assert np.allclose(whole, scorer.totals([codes, codes[:9]]))


def test_very_short_texts():
    scorer = language.Scorer([language.train([language.codes_of("some words to learn from")])])
    texts = [language.codes_of(t) for t in ("a", "ab", "", "1", "abc", "x" * 9)]
    sums = scorer.totals(texts)[:, 0, 0]
    alone = [scorer.totals([t])[0, 0, 0] for t in texts]
    assert np.allclose(sums, alone) and sums[2] == sums[3] == 0 and (sums[[0, 1, 4, 5]] > 0).all()


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.identify(docs.withColumn("score", F.lit(7)), language.fit_on(docs))
    rows = found.withColumn("held_out", language.held_out("doc_id")).filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    right = [r for r in rows if r.lang_pred == r.lang]
    assert len(right) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) / len(rows) < 0.002


def test_text_that_is_returned_goes_to_python_once(spark, capsys):
    model = {"langs": [], "models": [], "limits": [], "sharpness": 1.0}
    docs = spark.createDataFrame([(1, "some words", "x"), (2, None, "y")], "doc_id long, text string, source string")
    found = language.identify(docs, model)
    found.explain()
    assert "__text" not in capsys.readouterr().out
    assert [(r.doc_id, r.text, r.source, r.lang_pred) for r in found.orderBy("doc_id").collect()] == [(1, "some words", "x", "und"), (2, None, "y", "und")]


def test_rejects_foreign_text_and_keeps_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit_on(docs)
    odd = clashing(spark)
    found = language.identify(odd, model).collect()
    assert len(found) == len(odd_rows())
    for r in found:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.entropy, r.rejected) == ("und", 0.0, None, True)
        else:
            assert r.lang_pred in model["langs"]
    greek = spark.createDataFrame([(1, "αβγδε ζηθικ λμνξο " * 30)], "doc_id long, text string")
    assert language.identify(greek, model).first().rejected


@pytest.mark.parametrize("unlearned", ["en", "de", "es", "fr"])
def test_rejects_an_unlearned_language_of_the_same_script(spark, unlearned):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) >= 200")
    model = language.fit_on(docs.filter(F.col("lang") != unlearned))
    rows = language.identify(docs.filter(language.held_out("doc_id")), model).collect()
    foreign = [r.rejected for r in rows if r.lang == unlearned]
    assert sum(foreign) / len(foreign) > 0.9
    own = [r.rejected for r in rows if r.lang in model["langs"]]
    assert sum(own) / len(own) < 0.01
    # The rates that the model states for itself, from its held-back texts.
    assert model["lost"] < 0.02 and max(model["passed"]) < 0.2


@pytest.mark.parametrize("first", [1, 2])
def test_very_long_texts_do_not_fill_the_sample(spark, monkeypatch, first):
    learned = []
    monkeypatch.setattr(language, "calibrated", lambda models, back: learned.append(back) or {"limits": [], "sharpness": 1.0})
    docs = spark.range(100).selectExpr("cast(id as string) as key", "'xx' as lang", "concat('some words of text ', id % 7) as text")
    h = F.shiftrightunsigned(F.xxhash64("key", "lang"), 11)
    drawn = [r.key for r in docs.orderBy(h, "key").collect()]
    # One text longer than all others may be together, drawn at first or second.
    long_text = F.repeat(F.lit("long text "), 1 + language.SAMPLE_CHARS // 10)
    docs = docs.withColumn("text", F.when(F.col("key") == drawn[first - 1], long_text).otherwise(F.col("text")))
    language.fit(docs)
    assert len(learned[0][0]) == 100 // language.HELD_BACK


@pytest.mark.parametrize("repeated", [7, 8, 9, 10])
def test_a_language_whose_rows_all_have_one_id_is_learned(spark, repeated):
    english = spark.range(10_000).selectExpr(f"{repeated}L as doc_id", "'en' as lang", "concat('the words of row ', id, ' are these') as text")
    french = spark.range(300).selectExpr("1000 + 3 * id as doc_id", "'fr' as lang", "concat('les mots du texte ', id, ' sont ici') as text")
    model = language.fit_on(english.unionByName(french))
    assert model["langs"] == (["fr"] if held(repeated) else ["en", "fr"])
    found = language.identify(spark.createDataFrame([(1, "the words are these"), (2, "les mots sont ici")], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: model["langs"][0], 2: "fr"}


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_equal_rows_are_one_and_bounds_hold(spark, monkeypatch):
    monkeypatch.setattr(language, "calibrated", lambda models, back: {})
    letters = "chr(97 + id % 26), chr(97 + id div 26 % 26), chr(97 + id div 676 % 26)"
    one = spark.range(20_000).selectExpr("'1' as key", "'xx' as lang", f"if(id % 100 = 0, concat('text ', {letters}), 'hot') as text")
    sample = spy_on_sample(spark, monkeypatch, one, texts=30, chars=100, text_chars=50)
    assert len(sample) == len({r.text for r in sample}) <= 30 and sum(len(r.text) for r in sample) <= 100


def spy_on_sample(spark, monkeypatch, labelled, **bounds):
    """The rows that the models are learned from."""
    kept = []
    real = language.staged
    monkeypatch.setattr(language, "staged", lambda df, name: kept.append(real(df, name)) or kept[-1])
    language.fit(labelled, **bounds)
    return kept[0].collect()


def test_long_texts_are_read_throughout(spark, monkeypatch):
    monkeypatch.setattr(language, "calibrated", lambda models, back: {})
    text = "".join(chr(0x4E00 + i) for i in range(20_000))
    labelled = spark.createDataFrame([("1", "xx", text), ("2", "xx", "short")], "key string, lang string, text string")
    long, short = sorted((r.text for r in spy_on_sample(spark, monkeypatch, labelled, text_chars=1000)), key=len, reverse=True)
    tenths = [(ord(c) - 0x4E00) // 2000 for c in long if c != " "]
    assert short == "short" and len(tenths) == 1000 and all(tenths.count(i) == 100 for i in range(10))


def test_held_back_texts_are_not_learned_from(monkeypatch):
    monkeypatch.setattr(language, "train", lambda used: used)
    text = lambda i: language.codes_of(f"{'abcdefgh'[i]} words " * 20)
    for n in range(1, 9):
        used, back = language.divided([text(i) for i in range(n)])
        assert back and used and not {c.tobytes() for c in used} & {c.tobytes() for c in back}


def test_nothing_to_learn(spark):
    model = language.fit_on(empty_docs(spark))
    assert {r.lang_pred for r in language.identify(odd_docs(spark), model).collect()} == {"und"}
    assert language.identify(empty_docs(spark), model).count() == 0
