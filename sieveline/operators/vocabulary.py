"""The distinct tokens of a corpus, with tables that find the tokens of a fuzzy term or a pattern.

A fuzzy term or a pattern would otherwise be compared with every token of every text. Here the
distinct tokens (``vocabulary``) get two tables, built once and kept sorted by their first column:
``deletion_table`` with what is left of a token's beginning after up to ``d`` characters are deleted, and
``gram_table`` with the trigrams of a token. A term or pattern is turned into a few values that a
hit must have in the table, the rows with these values are met by equality, and the tokens found
are verified by the same matcher that a scan uses: the results are the same. A pattern that
requires no trigram is tried on all distinct tokens.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product
from operator import and_, or_
from re import _constants as op, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx
from ..functions.text import Fuzzy, Words
from ..schema import KEY
from ..sizing import broadcast_if_small

# Characters of a token that deletions are made from; more than any distance.
PREFIX = 7
GRAM = 3
# Marks of a token's start and end, which no token holds.
START, END = "^", "$"
# Alternatives of a pattern beyond which it is tried on all tokens.
MAX_ALTERNATIVES = 32


def vocabulary(postings: DataFrame) -> DataFrame:
    """(token, n): the distinct tokens of ``postings`` and the rows that hold them."""
    return postings.filter(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def prefix_of(distance: int) -> int:
    return max(PREFIX, distance + 1)


def deletions(word: str, distance: int) -> list[str]:
    """What is left of the first characters of a word after up to ``distance`` of them are deleted."""
    found = {word[: prefix_of(distance)]}
    for _ in range(distance):
        found |= {w[:i] + w[i + 1 :] for w in found for i in range(len(w))}
    return sorted(found)


def deletion_table(tokens: DataFrame, distance: int = tx.DEFAULT_FUZZY_DISTANCE) -> DataFrame:
    """(part, token): a row for everything ``deletions`` finds for a token; at most 29 a token for 2 edits.

    Two words within ``distance`` edits share a part: of their first characters, those that an edit
    touches, or that it moves across the end, are at most as many as the edits. An exchange of
    neighbours touches one character of each.
    """
    longest = prefix_of(distance)
    found = F.array(F.substring("token", 1, longest))

    def shorter(word: Column) -> Column:
        places = F.when(F.length(word) > 0, F.sequence(F.lit(1), F.length(word))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.lit(longest))))

    for _ in range(distance):
        found = F.array_distinct(F.concat(found, F.flatten(F.transform(found, shorter))))
    return tokens.select(F.explode(found).alias("part"), "token")


def fuzzy_tokens(parts: DataFrame, terms: Sequence[str], matcher: Fuzzy = Fuzzy()) -> DataFrame:
    """(term, token): the tokens within the matcher's edits of each term.

    ``parts`` is a ``deletion_table`` for at least as many edits.
    """
    distance = tx.fuzzy_distance(matcher.level)
    terms = list(dict.fromkeys(tx._single_term(t, matcher.words) for t in terms))
    wanted = [(t, part) for t in terms for part in deletions(t, distance)]
    # At most a few dozen rows per term; the reader is told the values, the join keeps term and token together.
    table = F.broadcast(parts.sparkSession.createDataFrame(wanted, "term string, part string"))
    met = parts.filter(F.col("part").isin([p for _, p in wanted])).join(table, "part").select("term", "token").distinct()
    hit = [(F.col("term") == t) & matcher.hits(F.col("token"), t) for t in terms]
    return met.filter(reduce(or_, hit)) if hit else met


def gram_table(tokens: DataFrame) -> DataFrame:
    """(gram, token): the distinct trigrams of every token between its marks."""
    marked = F.concat(F.lit(START), F.col("token"), F.lit(END))
    places = F.when(F.length("token") > 0, F.sequence(F.lit(1), F.length("token"))).otherwise(F.array().cast("array<int>"))
    grams = F.transform(places, lambda i: F.substring(marked, i, F.lit(GRAM)))
    return tokens.select(F.explode(F.array_distinct(grams)).alias("gram"), "token")


def grams_of(literal: str) -> frozenset[str]:
    return frozenset(literal[i : i + GRAM] for i in range(len(literal) - GRAM + 1))


def infix_grams(term: str) -> list[frozenset[str]]:
    return [grams_of(term)]


def wildcard_grams(pattern: str, words: Words = tx.LETTERS) -> list[frozenset[str]]:
    runs = re.split(r"[*?]", "".join([START, *words.pieces(pattern), END]))
    return [frozenset().union(*map(grams_of, runs))]


def regex_grams(pattern: str) -> list[frozenset[str]]:
    """Alternatives, one of which has all of its trigrams in every token that the pattern matches whole.

    Only what has to occur counts: literals that follow each other, repeated parts that occur at
    least once, and one branch of each choice. Whatever else there is requires nothing; so does a
    pattern that ignores case or that Python's parser does not know.
    """
    try:
        tree = parser.parse(pattern)
    except (re.error, OverflowError):
        return [frozenset()]
    # Octal escapes are read in another way.
    if tree.state.flags & (re.IGNORECASE | re.VERBOSE) or "\\0" in pattern:
        return [frozenset()]

    def required(items, begin: str = "", end: str = "") -> list[frozenset[str]] | None:
        found, run = [frozenset()], begin

        def also(options: list[frozenset[str]] | None) -> None:
            nonlocal found
            if options is not None:
                joined = [a | b for a, b in product(found, options)]
                # Too many alternatives: this part requires nothing.
                found = joined if len(joined) <= MAX_ALTERNATIVES else found

        for kind, value in items:
            if kind is op.LITERAL:
                run += chr(value)
                continue
            if kind is op.AT and value in (op.AT_BEGINNING, op.AT_BEGINNING_STRING, op.AT_END, op.AT_END_STRING):
                run = also([grams_of(run)]) or ""
                continue
            also([grams_of(run)])
            run = ""
            if kind is op.BRANCH:
                options = [required(branch) for branch in value[1]]
                also([x for o in options for x in o])
            elif kind is op.SUBPATTERN and not value[1]:
                also(required(value[3]))
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] > 0:
                also(required(value[2]))
            elif kind is op.ATOMIC_GROUP:
                also(required(value))
        also([grams_of(run + end)])
        return found

    return list(dict.fromkeys(required(list(tree), START, END)))


def pattern_tokens(
    tokens: DataFrame, grams: DataFrame, alternatives: Sequence[frozenset[str]], verify: Callable[[Column], Column]
) -> DataFrame:
    """(token): the tokens that pass ``verify``, of which those with an alternative's trigrams are tried."""
    token = F.col("token")
    if not all(alternatives):
        return tokens.filter(verify(token)).select("token")
    wanted = sorted(frozenset().union(*alternatives))
    held = grams.filter(F.col("gram").isin(wanted)).groupBy("token").agg(F.collect_set("gram").alias("__grams"))
    has = [reduce(and_, [F.array_contains("__grams", g) for g in sorted(a)]) for a in alternatives]
    return held.filter(reduce(or_, has)).select("token").filter(verify(token))


def infix_tokens(tokens: DataFrame, grams: DataFrame, term: str, words: Words = tx.LETTERS) -> DataFrame:
    """(token): the tokens that contain the term."""
    term = tx._single_term(term, words)
    return pattern_tokens(tokens, grams, infix_grams(term), lambda t: t.contains(term))


def wildcard_tokens(tokens: DataFrame, grams: DataFrame, pattern: str, words: Words = tx.LETTERS) -> DataFrame:
    """(token): the tokens that match a pattern with ``*`` and ``?``."""
    return pattern_tokens(tokens, grams, wildcard_grams(pattern, words), lambda t: tx.wildcard_match(t, pattern, words))


def regex_tokens(tokens: DataFrame, grams: DataFrame, pattern: str) -> DataFrame:
    """(token): the tokens that match a regular expression as a whole."""
    return pattern_tokens(tokens, grams, regex_grams(pattern), tx.whole_token(pattern))


def documents_with(postings: DataFrame, tokens: DataFrame, key: str = KEY) -> DataFrame:
    """(key): the documents that hold one of the tokens; the tokens are broadcast where they measure small."""
    found = tokens.select("token").distinct()
    return postings.join(broadcast_if_small(found), "token", "left_semi").select(key).distinct()
