"""Names, literals, value texts, geo distance and text matchers against plain Python."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F, types as T

from sieveline.functions import geo, text as tx
from sieveline.functions.values import invariant_text, plain_text, typed_literal
from sieveline.schema import FieldError, FieldSpec, normalize_columns, normalize_name, resolve, with_flags


@pytest.mark.parametrize(
    "raw,stored",
    [(None, None), ("", None), ("One--Two..Three  Four", "f_one__two__three__four"), ("Größe ٣", "f_größe_٣")],
)
def test_normalize_name(spark, raw, stored):
    assert normalize_name(raw, prefix="f_") == stored
    from sieveline.schema import normalize_name_column

    column = spark.createDataFrame([(raw,)], "n string").select(normalize_name_column(F.col("n"))).first()[0]
    assert column == (stored and stored.removeprefix("f_"))


def test_flags_survive_parquet(spark, tmp_path):
    df = with_flags(spark.createDataFrame([("a", 1)], "name string, size int"), "size", filterable=False)
    df.write.parquet(str(tmp_path / "t"))
    schema = spark.read.parquet(str(tmp_path / "t")).schema
    assert resolve(schema, "SIZE").filterable is False
    assert resolve(schema, "Name").filterable is True
    assert resolve(schema, "other") is None


def test_colliding_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, a_b int")
    with pytest.raises(FieldError):
        normalize_columns(df)
    assert FieldSpec("x", T.ArrayType(T.StringType())).is_collection


@pytest.mark.parametrize(
    "raw,kind,expected",
    [
        ("3", "int", True), ("3.0", "int", True), ("3.5", "int", False), ("99999999999", "int", False),
        ("3", "double", True), ("3", "bigint", True),
    ],
)
def test_numeric_literals(spark, raw, kind, expected):
    data_type = T._parse_datatype_string(kind)
    df = spark.createDataFrame([(3,)], "v int").select(F.col("v").cast(data_type).alias("v"))
    assert df.select(F.col("v") == typed_literal(raw, data_type)).first()[0] is expected


def test_bad_literals(spark):
    for raw, data_type in (("x", T.IntegerType()), ("yes", T.BooleanType()), ("1O", T.DoubleType())):
        with pytest.raises(ValueError):
            typed_literal(raw, data_type)


@pytest.mark.parametrize(
    "value,shown",
    [
        (5.0, "5"), (0.05, "0.05"), (-0.0, "0"), (1234567.5, "1234567.5"), (12345678.0, "12345678"),
        (123456789012.25, "123456789012.25"), (1e15, "1E+15"), (1.5e20, "1.5E+20"), (0.0001, "0.0001"),
        (0.00012345, "0.00012345"), (0.00001, "1E-05"), (1.25e-10, "1.25E-10"), (-2.5e8, "-250000000"),
        (float("nan"), "NaN"), (float("inf"), "Infinity"),
    ],
)
def test_value_text_of_doubles(spark, value, shown):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(invariant_text(plain_text(F.col("v"), T.DoubleType()), T.DoubleType())).first()[0] == shown


def test_value_text_of_instants(spark):
    df = spark.sql("SELECT timestamp '2017-04-28T15:24:31.180Z' AS v")
    shown = invariant_text(plain_text(F.col("v"), T.TimestampType()), T.TimestampType())
    assert df.select(shown).first()[0] == "04/28/2017 15:24:31 +00:00"


def distance(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((p - q) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b - d) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1, h)))


def test_box_keeps_every_near_point(spark):
    rng = random.Random(3)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(4000)]
    df = spark.createDataFrame(points, "lat double, lon double").cache()
    lat, lon = F.col("lat"), F.col("lon")
    for _ in range(12):
        at = (rng.choice([-89.5, -60.0, 0.0, 33.3, 80.0]), rng.choice([-179.0, -10.0, 0.0, 178.5]))
        km = rng.choice([50, 900, 4000, 12000])
        near = {p for p in points if distance(*p, *at) <= km}
        box = geo.within_box(lat, lon, *at, km)
        found = {tuple(r) for r in df.filter(box & (geo.haversine_km(lat, lon, *at) <= km)).collect()}
        assert found == near
    assert abs(distance(0, 14, 0, 24) - 1111.95) < 0.01


WORDS = ["shirt", "Shirts", "shrit", "sh", "red", "RED_2", "größe", "école", "t", "42nd", "a1", "i", "tshirt"]


def texts():
    rng = random.Random(5)
    gaps = [" ", "-", ". ", "\n", "'", "/"]
    return ["".join(rng.choice(WORDS) + rng.choice(gaps) for _ in range(rng.randint(0, 9))) for _ in range(400)] + [None]


def tokens(text):
    return re.findall(r"\w+", text.lower())


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def close(token, term, limit):
    return token == term if len(term) <= limit else edits(token, term) <= limit


def near(words, a, b, slop):
    return any(x == a and y == b and i != j and abs(i - j) - 1 <= slop
               for i, x in enumerate(words) for j, y in enumerate(words))


def phrase(words, terms):
    return any(words[i:i + len(terms)] == terms for i in range(len(words)))


MATCHERS = [
    (lambda c: tx.prefix_match(c, "Sh"), lambda w: any(t.startswith("sh") for t in w)),
    (lambda c: tx.prefix_match(c, "shirt", 1, 4), lambda w: False),
    (lambda c: tx.prefix_match(c, "t", 2, 4), lambda w: False),
    (lambda c: tx.infix_match(c, "hir"), lambda w: any("hir" in t for t in w)),
    (lambda c: tx.infix_match(c, "ö"), lambda w: any("ö" in t for t in w)),
    (lambda c: tx.word_match(c, "shirt"), lambda w: "shirt" in w),
    (lambda c: tx.word_match(c, "red"), lambda w: "red" in w),
    (lambda c: tx.word_match(c, "ÉCOLE"), lambda w: "école" in w),
    (lambda c: tx.fuzzy_match(c, "shirt"), lambda w: any(close(t, "shirt", 2) for t in w)),
    (lambda c: tx.fuzzy_match(c, "shirt", 1), lambda w: any(close(t, "shirt", 1) for t in w)),
    (lambda c: tx.fuzzy_match(c, "shirt", 0), lambda w: "shirt" in w),
    (lambda c: tx.fuzzy_match(c, "shirt", 3), lambda w: any(close(t, "shirt", 3) for t in w)),
    (lambda c: tx.fuzzy_match(c, "shirt", 7), lambda w: "shirt" in w),
    (lambda c: tx.phrase_match(c, ["red", "shirt"]), lambda w: phrase(w, ["red", "shirt"])),
    (lambda c: tx.fuzzy_match(c, "a1"), lambda w: "a1" in w),
    (lambda c: tx.wildcard_match(c, "sh*t"), lambda w: any(re.fullmatch(r"sh\w*t", t) for t in w)),
    (lambda c: tx.wildcard_match(c, "?1"), lambda w: any(re.fullmatch(r"\w1", t) for t in w)),
    (lambda c: tx.wildcard_match(c, "*irt*"), lambda w: any("irt" in t for t in w)),
    (lambda c: tx.wildcard_match(c, "*"), lambda w: bool(w)),
    (lambda c: tx.regex_match(c, "s.*t|r.d"), lambda w: any(re.fullmatch("s.*t|r.d", t) for t in w)),
    (lambda c: tx.proximity_match(c, ["red", "shirt"]), lambda w: phrase(w, ["red", "shirt"])),
    (lambda c: tx.proximity_match(c, ["t", "t"]), lambda w: phrase(w, ["t", "t"])),
    (lambda c: tx.proximity_match(c, ["red", "sh", "i"]), lambda w: phrase(w, ["red", "sh", "i"])),
    (lambda c: tx.proximity_match(c, ["red", "shirt"], 1), lambda w: near(w, "red", "shirt", 1)),
    (lambda c: tx.proximity_match(c, ["sh", "t"], 3), lambda w: near(w, "sh", "t", 3)),
    (lambda c: tx.proximity_match(c, ["red", "red"], 2), lambda w: near(w, "red", "red", 2)),
]
COUNTS = [
    (tx.Analysis(), "sh", lambda t: t.startswith("sh")),
    (tx.Analysis("ngram"), "h", lambda t: "h" in t),
    (tx.Analysis("ngram"), "i", lambda t: "i" in t),
    (tx.Analysis("word"), "red", lambda t: t == "red"),
    (tx.Analysis("edge", 3, 5), "sh", lambda t: False),
    (tx.Fuzzy(), "shirt", lambda t: close(t, "shirt", 2)),
    (tx.Fuzzy(1), "red", lambda t: close(t, "red", 1)),
]


def test_matchers(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").withColumn("t", tx.fold(F.col("t")))
    c = F.col("t")
    columns = [m(c).alias(f"m{i}") for i, (m, _) in enumerate(MATCHERS)]
    columns += [a.frequency(c, term).alias(f"c{i}") for i, (a, term, _) in enumerate(COUNTS)]
    columns += [a.matches(c, term).alias(f"h{i}") for i, (a, term, _) in enumerate(COUNTS)]
    for r in df.select("i", tx.tokens(c).alias("tokens"), tx.token_count(c).alias("n"), *columns).collect():
        if rows[r.i] is None:
            assert not any(r[f"m{i}"] for i in range(len(MATCHERS)))
            continue
        words = tokens(rows[r.i])
        assert (r.tokens, r.n) == (words, len(words))
        for i, (_, expected) in enumerate(MATCHERS):
            assert r[f"m{i}"] == expected(words), (i, rows[r.i])
        for i, (_, _, hit) in enumerate(COUNTS):
            assert r[f"c{i}"] == sum(map(hit, words)), (i, rows[r.i])
            assert r[f"h{i}"] == any(map(hit, words)), (i, rows[r.i])


def test_ngrams(spark):
    words = ["a", "ab", "abcd"]
    df = spark.createDataFrame([(words,)], "w array<string>")
    edge, infix = df.select(tx.ngrams(F.col("w"), 2, 3, True), tx.ngrams(F.col("w"), 2, 3, False)).first()
    assert edge == ["ab", "ab", "abc"]
    assert infix == ["ab", "ab", "abc", "bc", "bcd", "cd"]


def test_query_terms():
    assert tx.query_terms(" Red-shirt red ") == ["red", "shirt"]
    assert tx.query_terms("  ") == tx.query_terms(None) == tx.query_terms("!?") == []
    for bad in (lambda: tx.wildcard_match(F.lit("a"), "a b*"), lambda: tx.prefix_match(F.lit("a"), "a b")):
        with pytest.raises(ValueError):
            bad()
