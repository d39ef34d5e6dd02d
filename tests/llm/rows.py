"""Small inputs that every operator must take: nulls, empty and long texts, ties, clashing names."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORDS.findall(lowered(text))


def sentence(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


def odd_rows():
    """(doc_id, text, lang, source, n_chars)."""
    long_text = sentence(30_000)
    return [
        (1, sentence(40), "en", "a", 1),
        (2, sentence(40).upper(), "en", "a", 1),
        (3, sentence(41), "fr", "b", 1),
        (4, None, None, None, None),
        (5, "", "en", "a", 0),
        (6, " \t\n ", "de", None, 4),
        (7, "tiny", "en", "b", 4),
        (8, "Tiny", None, "b", 4),
        (9, long_text, "en", "a", None),
        (10, long_text + " tail", "en", "a", None),
        (10, long_text + " tail", "en", "a", None),
        (None, sentence(40), "en", "c", 1),
        (None, None, None, None, None),
        (11, "ÄÖÜ straße ÉCOLE été", "de", "c", 2),
        (12, "äÖÜ straße École été", "de", "c", 2),
        (13, "a b c d", "en", "a", 7),
        (14, "line one two\n\nline one two\n" + sentence(60), "en", "b", 9),
        (15, sentence(60) + "\nother line here", "en", "b", 9),
    ]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def clashing(spark):
    """The same rows with columns that are named like results and helpers of the operators."""
    from pyspark.sql import functions as F

    names = ["size", "taken", "target", "copies", "positions", "position", "shard", "slot", "region", "law", "kept", "keep_id",
             "lang_pred", "score", "rejected", "id", "key", "n", "component_id", "removed_lines", "runs", "ord", "seq", "chunk",
             "part", "counts", "grp", "item_id", "item", "words", "bucket", "weight", "knots", "total", "rank"]
    return odd_docs(spark).withColumns({n: F.lit("x") for n in names})


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
