"""Analysis of text columns and one-term matchers, all built-in expressions.

A token is by default a maximal run of letters, digits and underscores, lower-cased; with
``STANDARD_WORDS``, what the standard tokenizer takes for a word. Matchers take text that was
folded (``fold``) and prepared (``Words.prepared``): because a term holds token characters
only, "some token contains / starts with / equals the term" can be answered on
that text itself, without building an array of tokens or of grams per row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F, types as T

from .standard import standard_terms, token_text

# Characters of a token, as a regular-expression class.
TOKEN_CLASS = r"[\p{L}\p{N}_]"
SEPARATOR_CLASS = r"[^\p{L}\p{N}_]"
# Default gram lengths, default fuzzy distance.
DEFAULT_MIN_GRAM = 1
DEFAULT_MAX_GRAM = 20
DEFAULT_FUZZY_DISTANCE = 2

_TOKENS_PY = re.compile(r"\w+")


@dataclass(frozen=True)
class Words:
    """How folded texts and query texts are cut into tokens.

    ``token`` and ``separator`` are the classes of characters in and between the tokens of a
    *prepared* text, which is what the matchers take.
    """

    token: str
    separator: str
    standard: bool = False

    def prepared(self, folded: Column) -> Column:
        return token_text(folded) if self.standard else folded

    def terms(self, text: str | None) -> list[str]:
        """Tokens of a query text, in order."""
        return standard_terms(text or "") if self.standard else _TOKENS_PY.findall((text or "").lower())

    def pieces(self, pattern: str) -> list[str]:
        """Literals, ``*`` and ``?`` of a wildcard pattern."""
        return re.findall(r"[^\s*?]+|[*?]" if self.standard else r"\w+|[*?]", pattern.lower())

    def at_start(self, term: str) -> str:
        """Pattern of the term at the start of a token.

        The look-behind comes after the term: the pattern then begins with a literal,
        which is searched for as such, and looks around only where the term occurs.
        """
        term = re.escape(term)
        return f"{term}(?<!{self.token}{term})"

    @property
    def start(self) -> str:
        return f"(?<!{self.token})"

    @property
    def end(self) -> str:
        return f"(?!{self.token})"


# Runs of letters, digits and underscores; the matchers work on the text itself.
LETTERS = Words(TOKEN_CLASS, SEPARATOR_CLASS)
# Unicode word breaks; the matchers work on the tokens with spaces between, made once per row.
STANDARD_WORDS = Words("[^ ]", " ", True)


@dataclass(frozen=True)
class Analysis:
    """Index-side gram filter: ``edge`` (prefixes), ``ngram`` (substrings) or ``word``."""

    grams: str = "edge"
    min_gram: int = DEFAULT_MIN_GRAM
    max_gram: int = DEFAULT_MAX_GRAM
    words: Words = LETTERS

    def __post_init__(self):
        if self.grams not in ("edge", "ngram", "word"):
            raise ValueError(f"unknown gram filter {self.grams!r}")

    def matches(self, text: Column, term: str) -> Column:
        if self.grams == "edge":
            return prefix_match(text, term, self.min_gram, self.max_gram, self.words)
        if self.grams == "ngram":
            return infix_match(text, term, self.min_gram, self.max_gram, self.words)
        return word_match(text, term, self.words)

    def hits(self, token: Column, term: str) -> Column:
        """Whether the term hits one token."""
        if self.grams == "word":
            return token == term
        if not self.min_gram <= len(term) <= self.max_gram:
            return F.lit(False)
        return token.startswith(term) if self.grams == "edge" else token.contains(term)

    def frequency(self, text: Column, term: str) -> Column:
        """Number of tokens of ``text`` that the term hits."""
        if self.grams != "word" and not self.min_gram <= len(term) <= self.max_gram:
            return F.lit(0)
        if self.grams == "edge":
            pattern = self.words.at_start(term)
        elif self.grams == "ngram":
            # Each hit swallows the rest of its token, so a token counts once.
            pattern = rf"{re.escape(term)}{self.words.token}*+"
        else:
            pattern = self.words.at_start(term) + self.words.end
        return F.regexp_count(text, F.lit(pattern))


def fold(column: Column, data_type: T.DataType = T.StringType()) -> Column:
    """Lower-cased text; the elements of an array are kept apart by line breaks."""
    if isinstance(data_type, T.ArrayType):
        column = F.array_join(column, "\n")
    return F.lower(column)


def tokens(text: Column, words: Words = LETTERS) -> Column:
    """Array of the tokens of prepared text, in order."""
    return F.regexp_extract_all(text, F.lit(f"{words.token}++"), F.lit(0))


def token_count(text: Column, words: Words = LETTERS) -> Column:
    return F.regexp_count(text, F.lit(f"{words.token}++"))


def query_terms(text: str | None, words: Words = LETTERS) -> list[str]:
    """Distinct terms of a query text, in order."""
    return list(dict.fromkeys(words.terms(text)))


def _single_term(term: str, words: Words = LETTERS) -> str:
    folded = term.lower()
    if words.terms(term) != [folded]:
        raise ValueError(f"not a single term: {term!r}")
    return folded


def prefix_match(
    text: Column, term: str, min_gram: int = DEFAULT_MIN_GRAM, max_gram: int = DEFAULT_MAX_GRAM, words: Words = LETTERS
) -> Column:
    """Some token starts with the term, whose length is within the gram lengths."""
    term = _single_term(term, words)
    if not min_gram <= len(term) <= max_gram:
        return F.lit(False)
    return text.rlike(words.at_start(term))


def infix_match(
    text: Column, term: str, min_gram: int = DEFAULT_MIN_GRAM, max_gram: int = DEFAULT_MAX_GRAM, words: Words = LETTERS
) -> Column:
    """Some token contains the term, whose length is within the gram lengths."""
    term = _single_term(term, words)
    if not min_gram <= len(term) <= max_gram:
        return F.lit(False)
    return F.contains(text, F.lit(term))


def word_match(text: Column, term: str, words: Words = LETTERS) -> Column:
    """Some token equals the term."""
    term = _single_term(term, words)
    return text.rlike(words.at_start(term) + words.end)


def fuzzy_distance(level: int | None) -> int:
    return DEFAULT_FUZZY_DISTANCE if level is None else max(0, level)


def exchange_distance(token: Column, term: str) -> Column:
    """Edits between token and term where an exchange of neighbouring characters is one, and no
    character is edited twice: row by row of the table of distances, over the token's characters."""
    letters = F.array(*[F.lit(c) for c in term])
    first = F.sequence(F.lit(0), F.lit(len(term)))
    start = F.struct(first.alias("before"), first.alias("last"), F.lit("").alias("previous"), F.lit(0).alias("i"))

    def step(state: Column, char: Column) -> Column:
        def place(row: Column, j: Column) -> Column:
            # ``j`` counts the term's characters from 1, arrays are read from 0.
            here = F.get(letters, j - 1)
            least = F.least(
                F.get(state["last"], j) + 1, F.get(row, j - 1) + 1, F.get(state["last"], j - 1) + F.when(here == char, 0).otherwise(1)
            )
            exchanged = (j > 1) & (here == state["previous"]) & (F.get(letters, j - 2) == char)
            return F.concat(row, F.array(F.least(least, F.when(exchanged, F.get(state["before"], j - 2) + 1))))

        row = F.aggregate(F.sequence(F.lit(1), F.lit(len(term))), F.array(state["i"] + 1), place)
        return F.struct(state["last"].alias("before"), row.alias("last"), char.alias("previous"), (state["i"] + 1).alias("i"))

    return F.aggregate(F.split(token, ""), start, step, lambda state: F.get(state["last"], F.lit(len(term))))


def close_to(term: str, limit: int, transpositions: bool = False):
    """Whether a token is within ``limit`` edits of the term; an exchange of neighbours is one edit
    with ``transpositions``, else two."""

    def close(token: Column) -> Column:
        near_length = F.length(token).between(len(term) - limit, len(term) + limit)
        near = F.levenshtein(token, F.lit(term), limit) >= 0
        if transpositions:
            # Exchanges are two edits each: few tokens come to the table of distances.
            near = near | ((F.levenshtein(token, F.lit(term), 2 * limit) >= 0) & (exchange_distance(token, term) <= limit))
        return near_length & near

    return close


def fuzzy_match(
    text: Column, term: str, level: int | None = None, transpositions: bool = False, words: Words = LETTERS
) -> Column:
    """Some token is within the edit distance; terms no longer than it must match exactly."""
    term, limit = _single_term(term, words), fuzzy_distance(level)
    if len(term) <= limit or limit == 0:
        return word_match(text, term, words)
    return F.exists(tokens(text, words), close_to(term, limit, transpositions))


@dataclass(frozen=True)
class Fuzzy:
    """Fuzzy counterpart of ``Analysis``: whole tokens within an edit distance (default 2)."""

    level: int | None = None
    transpositions: bool = False
    words: Words = LETTERS

    def matches(self, text: Column, term: str) -> Column:
        return fuzzy_match(text, term, self.level, self.transpositions, self.words)

    def hits(self, token: Column, term: str) -> Column:
        limit = fuzzy_distance(self.level)
        if len(term) <= limit or limit == 0:
            return token == term
        return close_to(term, limit, self.transpositions)(token)

    def frequency(self, text: Column, term: str) -> Column:
        limit = fuzzy_distance(self.level)
        if len(term) <= limit or limit == 0:
            return Analysis("word", words=self.words).frequency(text, term)
        return F.size(F.filter(tokens(text, self.words), close_to(term, limit, self.transpositions)))


def wildcard_pattern(pattern: str, words: Words = LETTERS) -> str:
    pieces = words.pieces(pattern)
    body = "".join({"*": f"{words.token}*", "?": words.token}.get(p, re.escape(p)) for p in pieces)
    if set(pieces) == {"*"}:
        body = f"{words.token}+"
    return words.start + body + words.end


def wildcard_match(text: Column, pattern: str, words: Words = LETTERS) -> Column:
    """Some token matches a pattern with ``*`` (any run) and ``?`` (one character)."""
    pieces = words.pieces(pattern)
    if "".join(pieces) != pattern.lower() or not pieces:
        raise ValueError(f"not a wildcard pattern over one token: {pattern!r}")
    test = text.rlike(wildcard_pattern(pattern, words))
    for literal in sorted((p for p in pieces if p not in "*?"), key=len, reverse=True)[:1]:
        test = F.contains(text, F.lit(literal)) & test
    return test


def regex_match(text: Column, pattern: str, words: Words = LETTERS) -> Column:
    """Some whole token matches the regular expression."""
    return F.exists(tokens(text, words), whole_token(pattern))


def whole_token(pattern: str):
    return lambda token: token.rlike(rf"\A(?:{pattern})\z")


def phrase_terms(text: str, words: Words = LETTERS) -> list[str]:
    """Terms of a phrase in order, repeated ones too."""
    terms = words.terms(text)
    if not terms:
        raise ValueError(f"a phrase without a term: {text!r}")
    return terms


def phrase_pattern(terms: Sequence[str], words: Words = LETTERS) -> str:
    return words.at_start(terms[0]) + "".join(f"{words.separator}++{re.escape(t)}" for t in terms[1:]) + words.end


def phrase_match(text: Column, terms: Sequence[str], words: Words = LETTERS) -> Column:
    """The terms as whole tokens, each directly after the one before."""
    present = [F.contains(text, F.lit(t)) for t in dict.fromkeys(terms)]
    return reduce(and_, [*present, text.rlike(phrase_pattern(terms, words))])


def proximity_match(text: Column, terms: Sequence[str], slop: int = 0, words: Words = LETTERS) -> Column:
    """Slop 0: the terms as a phrase.  Else: the terms in any order, at most ``slop`` other tokens between.

    A term given twice has to be there twice.
    """
    terms = [_single_term(t, words) for t in terms]
    if len(terms) < 2:
        raise ValueError("proximity takes at least two terms")
    if slop and len(terms) > 2:
        return window_match(text, terms, slop, words)
    orders = [terms, terms[::-1]] if slop else [terms]
    gap = rf"(?:{words.separator}++{words.token}++){{0,{slop}}}{words.separator}++"
    present = [F.contains(text, F.lit(w)) for w in dict.fromkeys(terms)]
    ordered = [words.at_start(a) + "".join(gap + re.escape(t) for t in rest) + words.end for a, *rest in orders]
    return reduce(and_, [*present, text.rlike("|".join(ordered))])


def window_match(text: Column, terms: Sequence[str], slop: int, words: Words = LETTERS) -> Column:
    """Some window of tokens holds all the terms, in any order, and at most ``slop`` other tokens.

    One pass over the places of the terms in text order: of every term the last places are kept, as
    many as the term is given, and a window from the oldest of them to the present place is the
    least that ends there.
    """
    kinds = list(dict.fromkeys(terms))
    present = [F.contains(text, F.lit(k)) for k in kinds]
    placed = F.transform(tokens(text, words), lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    mine = F.filter(placed, lambda x: x["t"].isin(kinds))
    # Slots of a term: its last places, latest first.
    slots = [(k, j) for k in kinds for j in range(list(terms).count(k))]
    none = F.lit(None).cast("int")
    start = F.struct(*[none.alias(f"s{n}") for n in range(len(slots))], none.alias("least"))

    def step(state: Column, x: Column) -> Column:
        after = [
            F.when(x["t"] == k, state[f"s{n - 1}"] if j else x["i"]).otherwise(state[f"s{n}"])
            for n, (k, j) in enumerate(slots)
        ]
        full = reduce(and_, [a.isNotNull() for a in after])
        width = F.when(full, x["i"] - F.least(*after) + 1)
        return F.struct(*[a.alias(f"s{n}") for n, a in enumerate(after)], F.least(state["least"], width).alias("least"))

    least = F.aggregate(mine, start, step, lambda state: state["least"])
    return reduce(and_, [*present, F.coalesce(least - len(terms) <= slop, F.lit(False))])


def ngrams(token_array: Column, min_gram: int, max_gram: int, edge: bool) -> Column:
    """Every prefix (``edge``) or substring of each token within the gram lengths."""

    def of_token(token: Column) -> Column:
        size = F.length(token)

        def from_start(start: Column) -> Column:
            longest = F.least(F.lit(max_gram), size - start + 1)
            lengths = F.sequence(F.lit(min_gram), longest)
            return F.transform(lengths, lambda n: F.substring(token, start, n))

        if edge:
            grams = from_start(F.lit(1))
        else:
            starts = F.sequence(F.lit(1), size - F.lit(min_gram) + 1)
            grams = F.flatten(F.transform(starts, from_start))
        return F.when(size >= min_gram, grams).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(token_array, of_token))
