"""Type-ahead from tables that are built once: a keystroke reads one prefix instead of all texts.

``completion_pairs`` has a row for every prefix of a token of a suggestable text; ``completions`` keeps the
first few texts of each prefix, cut on the map side before the shuffle. A query of one term reads its row
there. A query of several terms reads the pairs of its longest earlier word, which are the texts
that hold that word, and matches the rest on them. The answers equal those of ``suggest``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as tx
from ..schema import FieldError, column, require, resolve

SIZE = 5


def _texts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    known = [require(s, "suggestable") for s in (resolve(df.schema, name) for name in fields) if s is not None]
    if any(not s.is_text for s in known):
        raise FieldError("suggestions need text fields")
    nothing = F.array().cast("array<string>")
    values = [column(s) if s.is_collection else F.array(column(s)) for s in known]
    texts = F.concat(*[F.coalesce(v, nothing) for v in values]) if values else nothing
    return df.select(F.explode(texts).alias("text")).filter(F.col("text").isNotNull()).distinct()


def completion_pairs(df: DataFrame, fields: Sequence[str], longest: int = tx.DEFAULT_MAX_GRAM, words: tx.Words = tx.LETTERS) -> DataFrame:
    """(prefix, word, text): the distinct texts under each token, and under its prefixes up to ``longest``.

    ``word`` says that the prefix is a whole token of the text. Write it sorted by prefix.
    """
    found = F.array_distinct(tx.tokens(words.prepared(tx.fold(F.col("text"))), words))
    tokens = _texts(df, fields).select("text", F.explode(found).alias("token"))
    starts = F.transform(F.sequence(F.lit(1), F.least(F.length("token"), F.lit(longest))), lambda n: F.substring("token", F.lit(1), n))
    prefixes = F.array_distinct(F.concat(starts, F.array("token")))
    rows = tokens.select("text", "token", F.explode(prefixes).alias("prefix"))
    return rows.groupBy("prefix", "text").agg(F.max(F.col("prefix") == F.col("token")).alias("word")).select("prefix", "word", "text")


def _first(pairs: DataFrame, size: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("prefix").orderBy("text"))
    kept = pairs.select("prefix", "text", rank.alias("__rank")).filter(F.col("__rank") <= size)
    return kept.groupBy("prefix").agg(F.array_sort(F.collect_list("text")).alias("texts"))


def completions(pairs: DataFrame, size: int = SIZE) -> DataFrame:
    """(prefix, texts): the first ``size`` texts of every prefix, in text order."""
    return _first(pairs, size)


def merge_completions(old: DataFrame, new: DataFrame, size: int = SIZE) -> DataFrame:
    """Completions of old and new texts together, from the completions of each of the same size."""
    both = old.unionByName(new).select("prefix", F.explode("texts").alias("text")).distinct()
    return _first(both, size)


def complete(
    table: DataFrame, pairs: DataFrame, query: str | None, size: int = SIZE, longest: int = tx.DEFAULT_MAX_GRAM, words: tx.Words = tx.LETTERS
) -> DataFrame:
    """(text): up to ``size`` texts that complete the query, in text order.

    The last term is a prefix of some token, the terms before it are whole tokens. ``size`` is at
    most that of ``table``; a last term longer than ``longest`` is looked up by its beginning.
    """
    terms = tx.query_terms(query, words)
    if not terms:
        return table.sparkSession.createDataFrame([], "text string")
    *before, last = terms
    if not before and len(last) <= longest:
        found = table.filter(F.col("prefix") == last).select(F.explode("texts").alias("text"))
        return found.orderBy("text").limit(size)
    key = max(before, key=len) if before else last[:longest]
    found = pairs.filter(F.col("prefix") == key)
    text = words.prepared(tx.fold(F.col("text")))
    tests: list[Column] = [tx.word_match(text, t, words) for t in before if t != key]
    tests.append(tx.prefix_match(text, last, 1, len(last), words))
    found = found.filter(F.col("word")) if before else found
    return found.filter(reduce(and_, tests)).select("text").orderBy("text").limit(size)
