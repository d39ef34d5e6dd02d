"""Standard tokens, windows of terms, and tokens found through tables against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sieveline import KEY, STANDARD_WORDS, Analysis, Fuzzy, search_text
from sieveline.functions import standard, text as tx
from sieveline.operators import vocabulary as vocab
from sieveline.operators.postings import build_postings, token_keys
from test_functions import edits

TOKENS = {
    "can't stop, 3.14 or 1,000.50; U.S.A. foo.bar": ["can't", "stop", "3.14", "or", "1,000.50", "u.s.a", "foo.bar"],
    "1:30 a:b x_y __ _a_ 5' ''a'' 3.a a.3 a1.5b": ["1", "30", "a:b", "x_y", "_a_", "5", "a", "3", "a", "a", "3", "a1.5b"],
    "漢字かな カタカナー 한국어 ภาษาไทย été 👍 ½": ["漢", "字", "か", "な", "カタカナー", "한국어", "ภาษาไทย", "été"],
    "z​z q‍q L’été": ["z", "z", "q‍q", "l’été"],
    "a" * 300 + " - ": ["a" * 255, "a" * 45],
    "": [],
    " -- ' . ": [],
}


@pytest.mark.parametrize("text", TOKENS)
def test_standard_terms(text):
    assert standard.standard_terms(text) == TOKENS[text]


def random_texts(n=1500):
    r = random.Random(1)
    pool = [*"ab1.,':;_ -’·漢かカーภ한́​‍²ⅧßE٣ǅ\n", "can't", "3.14", "a b", "漢"]
    return ["".join(r.choice(pool) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_columns_and_query_texts_are_cut_alike(spark):
    df = spark.createDataFrame([(t,) for t in [*random_texts(), *TOKENS, None]], "t string")
    prepared = STANDARD_WORDS.prepared(tx.fold(F.col("t")))
    columns = [standard.standard_tokens(F.lower("t")).alias("a"), tx.tokens(prepared, STANDARD_WORDS).alias("b"), tx.token_count(prepared, STANDARD_WORDS).alias("n")]
    for r in df.select("t", *columns).collect():
        if r.t is None:
            assert r.a is None and r.b is None and r.n is None
        else:
            assert r.a == r.b == standard.standard_terms(r.t) and r.n == len(r.a)


def test_plain_tokens_are_standard_tokens(spark):
    """What is taken for a token by its letters alone is one; long tokens are cut in the same places."""
    r = random.Random(6)
    letters = "abzßéÿ ,.\n'’:;_19-カ漢\u0301\u00ad"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * n + s + "b" * m + " c" for n in (0, 1, 254, 255, 256, 510, 700) for m in (0, 1, 256) for s in (" ", "", "'", ". ")]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.regexp_extract_all("t", F.lit(standard.STANDARD), F.lit(0))
    for r in rows.select("t", whole.alias("a"), standard.standard_tokens(F.col("t")).alias("b")).collect():
        assert r.b == [t[i : i + 255] for t in r.a for i in range(0, len(t), 255)], r.t
    assert spark.range(1).select(F.regexp_extract_all(F.lit("red, blue. é1 grün"), F.lit(standard._PLAIN), F.lit(0))).first()[0] == ["red", "blue", "grün"]


def test_a_search_by_standard_tokens_cuts_a_text_once(spark):
    rows = [("The end of it",), ("of the",), ("other office",), ("the",), (None,), ("of, a the'm",)]
    df = spark.createDataFrame(rows, "text string")
    found = search_text(df, "the of", ["text"], Analysis("word", words=STANDARD_WORDS))
    assert sorted(r.text for r in found.collect()) == ["The end of it", "of the"] and found.columns == ["text"]
    assert found._jdf.queryExecution().executedPlan().toString().count("regexp_replace") == 1


W = STANDARD_WORDS
MATCHERS = [
    (lambda c: tx.prefix_match(c, "3.1", words=W), lambda w: any(t.startswith("3.1") for t in w)),
    (lambda c: tx.prefix_match(c, "a", words=W), lambda w: any(t.startswith("a") for t in w)),
    (lambda c: tx.infix_match(c, "n't", words=W), lambda w: any("n't" in t for t in w)),
    (lambda c: tx.infix_match(c, "3.14", words=W), lambda w: any("3.14" in t for t in w)),
    (lambda c: tx.word_match(c, "can't", W), lambda w: "can't" in w),
    (lambda c: tx.word_match(c, "漢", W), lambda w: "漢" in w),
    (lambda c: tx.wildcard_match(c, "c*'?", W), lambda w: any(re.fullmatch("c.*'.", t) for t in w)),
    (lambda c: tx.wildcard_match(c, "3.*", W), lambda w: any(t.startswith("3.") for t in w)),
    (lambda c: tx.regex_match(c, r"[0-9]+\.[0-9]+", W), lambda w: any(re.fullmatch(r"[0-9]+\.[0-9]+", t) for t in w)),
    (lambda c: tx.phrase_match(c, ["a", "b"], W), lambda w: ("a", "b") in zip(w, w[1:])),
    (lambda c: tx.phrase_match(c, ["a", "漢"], W), lambda w: ("a", "漢") in zip(w, w[1:])),
    (lambda c: tx.proximity_match(c, ["a", "b"], 1, W), lambda w: windows(w, ["a", "b"], 1)),
    (lambda c: tx.fuzzy_match(c, "can't", 1, words=W), lambda w: any(edits(t, "can't") <= 1 for t in w)),
]


def test_matchers_on_standard_tokens(spark):
    df = spark.createDataFrame([(t,) for t in random_texts()], "t string").withColumn("p", W.prepared(tx.fold(F.col("t"))))
    rows = df.select("t", *[m(F.col("p")).alias(f"m{i}") for i, (m, _) in enumerate(MATCHERS)]).collect()
    for i, (_, expected) in enumerate(MATCHERS):
        found = [r[f"m{i}"] for r in rows]
        assert any(found) and found == [expected(standard.standard_terms(r.t)) for r in rows], i


def test_only_single_terms_are_taken():
    for bad in ("can'", "a b", "漢字", "-"):
        with pytest.raises(ValueError):
            tx.prefix_match(F.lit("a"), bad, words=W)


def test_frequencies_on_standard_tokens(spark):
    df = spark.createDataFrame([(t,) for t in random_texts()], "t string").withColumn("p", W.prepared(tx.fold(F.col("t"))))
    checks = [(Analysis("word", words=W), "can't", lambda t: t == "can't"), (Analysis(words=W), "3.14", lambda t: t.startswith("3.14")),
              (Analysis("ngram", words=W), "a", lambda t: "a" in t), (Fuzzy(1, words=W), "3.14", lambda t: edits(t, "3.14") <= 1)]
    for r in df.select("t", *[a.frequency(F.col("p"), term).alias(f"n{i}") for i, (a, term, _) in enumerate(checks)]).collect():
        for i, (_, _, hit) in enumerate(checks):
            assert r[f"n{i}"] == sum(map(hit, standard.standard_terms(r.t)))


def windows(words, terms, slop):
    """Whether a window has all the terms, as often as given, and at most ``slop`` other tokens."""
    wide = len(terms) + slop
    return any(all(words[i : i + wide].count(t) >= terms.count(t) for t in terms) for i in range(len(words)))


def test_windows_of_many_terms(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice("abcdxyz") for _ in range(r.randint(0, 25))) for _ in range(800)]
    queries = [(["a", "b", "c"], 2), (["a", "a", "b"], 1), (["a", "b", "a", "b"], 3), (["a", "b", "c", "d"], 6), (["a", "a", "a"], 4), (["c", "b", "a"], 1)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    rows = df.select("t", *[tx.proximity_match(F.col("t"), q, slop).alias(f"m{i}") for i, (q, slop) in enumerate(queries)]).collect()
    for i, (q, slop) in enumerate(queries):
        found = [x[f"m{i}"] for x in rows if x.t is not None]
        assert any(found) and not all(found) and found == [windows(t.split(), q, slop) for t in texts], q
    assert not any(rows[-1][f"m{i}"] for i in range(len(queries)))


def swaps_and_edits(a, b):
    """Edits where an exchange of neighbours is one, no place being edited twice."""
    rows = [list(range(len(b) + 1))]
    for i in range(1, len(a) + 1):
        row = [i]
        for j in range(1, len(b) + 1):
            least = min(rows[i - 1][j] + 1, row[j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                least = min(least, rows[i - 2][j - 2] + 1)
            row.append(least)
        rows.append(row)
    return rows[-1][-1]


@pytest.fixture(scope="module")
def words():
    r = random.Random(9)
    base = ["".join(r.choice("abcd") for _ in range(r.randint(1, 12))) for _ in range(1500)]
    return sorted({*base, "ab", "ba", "straße", "widget", "wigdet", "gadget", "x" * 30, "x" * 31, "9to5"})


@pytest.fixture(scope="module")
def tokens(spark, words):
    return spark.createDataFrame([(w,) for w in words], "token string")


@pytest.mark.parametrize("distance", [1, 2, 3])
@pytest.mark.parametrize("transpositions", [False, True])
def test_fuzzy_tokens(tokens, words, distance, transpositions):
    terms = ["abcdabcd", "widget", "ab", "x" * 32, "straBe", "cabbda", "d"]
    matcher = Fuzzy(distance, transpositions)
    found = {(r.term, r.token) for r in vocab.fuzzy_tokens(vocab.deletion_table(tokens, distance), terms, matcher).collect()}
    count = swaps_and_edits if transpositions else edits
    terms = [t.lower() for t in terms]
    assert found == {(t, w) for t in terms for w in words if (t == w if len(t) <= distance else count(t, w) <= distance)}
    scan = {(t, r.token) for t in terms for r in tokens.filter(matcher.matches(F.col("token"), t)).collect()}
    assert found == scan


def test_few_tokens_are_compared(spark):
    r = random.Random(2)
    many = spark.createDataFrame([("".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(4, 10))),) for _ in range(20_000)], "token string").distinct()
    parts = vocab.deletion_table(many)
    near = parts.filter(F.col("part").isin(vocab.deletions("abcdefgh", 2))).select("token").distinct().count()
    assert near < 0.02 * many.count()
    assert parts.groupBy("token").count().agg(F.max("count")).first()[0] <= 29


def test_vocabulary_is_met_by_equality(spark, tokens, tmp_path):
    vocab.deletion_table(tokens).sort("part").write.parquet(str(tmp_path / "parts"))
    vocab.gram_table(tokens).sort("gram").write.parquet(str(tmp_path / "grams"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    text = plan(vocab.fuzzy_tokens(spark.read.parquet(str(tmp_path / "parts")), ["widget"]))
    assert "BroadcastHashJoin [part" in text and "In(part, [" in text and "Cartesian" not in text and "NestedLoop" not in text
    assert text.index("INSET") < text.index("levenshtein")  # only rows with a part of the term's are compared
    text = plan(vocab.wildcard_tokens(tokens, spark.read.parquet(str(tmp_path / "grams")), "wid*t"))
    assert "In(gram, [" in text and text.count("FileScan") == 1 and "ExistingRDD" not in text


PATTERNS = ["abc.*", "a(bc|cd)a.*", "(abc)+d?", "(?:ab){2,}.*", "w[a-z]dget|gadget", ".*", "a.b.c", "abcd|.*dd", "(abc)?d.*", "(?i)WIDGET", "x{30}", "x{30,31}",
            "^abc.*$", r"\dto\d", "(?:a|b|c|d)(?:a|b|c|d)(?:ab|cd)a*", r"wid\Qget\E", "abc(?=d).*", "((ab|cd)(abc|bcd)){1,2}", r"\0141bc.*", "(a)b\\1.*", "stra(ß|ss)e"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_regex_tokens(tokens, pattern):
    grams = vocab.gram_table(tokens)
    found = {r.token for r in vocab.regex_tokens(tokens, grams, pattern).collect()}
    assert found == {r.token for r in tokens.filter(tx.whole_token(pattern)(F.col("token"))).collect()}


def test_trigrams_that_patterns_require():
    assert vocab.regex_grams("abcd.*") == [frozenset({"^ab", "abc", "bcd"})]
    assert set(vocab.regex_grams("x.*(abc|bcd)")) == {frozenset({"abc"}), frozenset({"bcd"})}
    assert vocab.regex_grams("(abc)+") == vocab.regex_grams("(abc)++") == [frozenset({"abc"})]
    for nothing in ("(abc)?", "(abc)*", ".*", "(?i)abc", r"\p{L}abc", "a|bcde"):
        assert not all(vocab.regex_grams(nothing))
    assert len(vocab.regex_grams("(abc|bcd)" * 20)) <= vocab.MAX_ALTERNATIVES


@pytest.mark.parametrize("pattern", ["wid*", "*get", "ab*cd?", "?b*", "*", "*abc*d*", "widget"])
def test_wildcard_tokens(tokens, pattern):
    found = {r.token for r in vocab.wildcard_tokens(tokens, vocab.gram_table(tokens), pattern).collect()}
    assert found == {r.token for r in tokens.filter(tx.wildcard_match(F.col("token"), pattern)).collect()}


@pytest.mark.parametrize("term", ["abc", "ADGE", "ab", "nowhere"])
def test_infix_tokens(tokens, words, term):
    found = {r.token for r in vocab.infix_tokens(tokens, vocab.gram_table(tokens), term).collect()}
    assert found == {w for w in words if term.lower() in w}


def test_documents_with_tokens(spark):
    df = spark.createDataFrame([("1", "red widget"), ("2", "wigdet"), ("3", None), ("4", ""), ("5", "gadget red")], f"{KEY} string, t string")
    postings = build_postings(df, ["t"])
    tokens = vocab.vocabulary(postings)
    assert {r.token: r.n for r in tokens.collect()} == {"red": 2, "widget": 1, "wigdet": 1, "gadget": 1}
    near = vocab.fuzzy_tokens(vocab.deletion_table(tokens), ["widget"])
    assert {r[KEY] for r in vocab.documents_with(postings, near).collect()} == {"1", "2", "5"}
    assert vocab.fuzzy_tokens(vocab.deletion_table(tokens), []).count() == 0
    none = tokens.limit(0)
    assert vocab.documents_with(postings, none).count() == vocab.fuzzy_tokens(vocab.deletion_table(none), ["red"]).count() == 0


def test_token_keys_are_those_of_postings_without_a_shuffle(spark):
    texts = ["red Red blue", "blue-green", "", None, "a a a b", "red"]
    rows = [(str(i), t, f"{t} also") for i, t in enumerate(texts)] + [(None, "lost red", None)]
    df = spark.createDataFrame(rows, f"{KEY} string, t string, u string")
    for fields in (["t"], ["t", "u"]):
        found = token_keys(df, fields)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        wanted = build_postings(df, fields).select("token", KEY).filter("token is not null")
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
        counts = lambda postings: sorted(map(tuple, vocab.vocabulary(postings).collect()))
        assert counts(found) == counts(wanted)


def test_swapped_tokens_write_nothing_before(spark, monkeypatch):
    from checks import vocabulary as checks
    from conftest import SF

    monkeypatch.setattr(checks, "corpus", None)
    # Texts are cut in the plan that finds the tokens, and no postings are written before it.
    plan = checks.fuzzy_swapped_tokens(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan
