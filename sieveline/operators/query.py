"""Text query trees: what a text must contain, as dataclasses compiled like filters.

A plain string stands for all of its terms. Leaves (terms, phrases, patterns) match and are
counted in every searchable field, or in the field that :class:`InField` names; what matches
adds to the score, except below :class:`NoneOf`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F, types as T

from ..functions import text as tx
from ..functions.text import Analysis, Fuzzy
from ..schema import FieldSpec, normalize_name
from .matching import searchable_fields, target


@dataclass(frozen=True)
class Match:
    """One term, matched as the request matches terms, or by ``fuzziness``."""

    term: str
    fuzziness: int | None = None

    def _matcher(self, matcher: Analysis | Fuzzy) -> Analysis | Fuzzy:
        return matcher if self.fuzziness is None else Fuzzy(self.fuzziness, words=matcher.words)

    def matches(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return self._matcher(matcher).matches(text, self.term)

    def frequency(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return self._matcher(matcher).frequency(text, self.term.lower())


@dataclass(frozen=True)
class Phrase:
    """Whole tokens, one directly after the other."""

    text: str

    def matches(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return tx.phrase_match(text, tx.phrase_terms(self.text, matcher.words), matcher.words)

    def frequency(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return F.regexp_count(text, F.lit(tx.phrase_pattern(tx.phrase_terms(self.text, matcher.words), matcher.words)))


@dataclass(frozen=True)
class Wildcard:
    """A whole token with ``*`` for any run of characters and ``?`` for one."""

    pattern: str

    def matches(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return tx.wildcard_match(text, self.pattern, matcher.words)

    def frequency(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return F.regexp_count(text, F.lit(tx.wildcard_pattern(self.pattern, matcher.words)))


@dataclass(frozen=True)
class Regex:
    """A whole token that matches a regular expression."""

    pattern: str

    def matches(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return tx.regex_match(text, self.pattern, matcher.words)

    def frequency(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return F.size(F.filter(tx.tokens(text, matcher.words), tx.whole_token(self.pattern)))


@dataclass(frozen=True)
class Near:
    """Two tokens, in any order, with at most ``slop`` others between; counts once for a text."""

    first: str
    second: str
    slop: int

    def matches(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return tx.proximity_match(text, [self.first, self.second], self.slop, matcher.words)

    def frequency(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return F.when(self.matches(text, matcher), 1).otherwise(0)


@dataclass(frozen=True, init=False)
class NearAll:
    """Any number of tokens, in any order, with at most ``slop`` others between; counts once for a text."""

    terms: tuple
    slop: int

    def __init__(self, *terms: str, slop: int):
        object.__setattr__(self, "terms", terms)
        object.__setattr__(self, "slop", slop)

    def matches(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return tx.proximity_match(text, self.terms, self.slop, matcher.words)

    def frequency(self, text: Column, matcher: Analysis | Fuzzy) -> Column:
        return F.when(self.matches(text, matcher), 1).otherwise(0)


@dataclass(frozen=True)
class InField:
    field: str
    child: object


@dataclass(frozen=True)
class Boost:
    """What ``child`` adds to the score, times ``weight``."""

    child: object
    weight: float


@dataclass(frozen=True, init=False)
class _Group:
    children: tuple

    def __init__(self, *children):
        object.__setattr__(self, "children", children)


class AllOf(_Group):
    pass


class AnyOf(_Group):
    pass


class NoneOf(_Group):
    pass


@dataclass(frozen=True)
class Unit:
    """A leaf that adds to the score, with its weight and the field it is bound to."""

    leaf: object
    weight: float = 1.0
    field: str | None = None

    def in_field(self, spec: FieldSpec) -> bool:
        return self.field is None or normalize_name(spec.name) == normalize_name(self.field)


def parsed(text, words: tx.Words = tx.LETTERS) -> object | None:
    """The tree of a query: a string's terms all have to match; blank is ``None``."""
    if text is None or isinstance(text, str):
        terms = tx.query_terms(text, words)
        return AllOf(*map(Match, terms)) if terms else None
    return text


def units(text, boosts: dict[str, float] | None = None, words: tx.Words = tx.LETTERS) -> list[Unit]:
    """Scored leaves of a query in order; equal ones in one field count once, with the last weight."""
    boosts = {term.lower(): float(weight) for term, weight in (boosts or {}).items()}
    found: dict[tuple, float] = {}

    def visit(node, weight: float, field: str | None) -> None:
        node = parsed(node, words)
        if node is None or isinstance(node, NoneOf):
            return
        if isinstance(node, Boost):
            visit(node.child, weight * node.weight, field)
        elif isinstance(node, InField):
            visit(node.child, weight, node.field)
        elif isinstance(node, _Group):
            for child in node.children:
                visit(child, weight, field)
        else:
            own = boosts.get(node.term.lower(), 1.0) if isinstance(node, Match) else 1.0
            found[node, field] = weight * own

    visit(text, 1.0, None)
    return [Unit(leaf, weight, field) for (leaf, field), weight in found.items()]


def query_condition(
    schema: T.StructType, text, fields: Sequence[str] | None = None, matcher: Analysis | Fuzzy = Analysis()
) -> Column | None:
    """Condition of a query tree or string; ``None`` where it asks for nothing.

    A text that is null matches no leaf. A group without children, or with blank ones only,
    asks for nothing; an unknown field matches nothing.
    """

    def compiled(node, targets: list[Column]) -> Column | None:
        node = parsed(node, matcher.words)
        if node is None:
            return None
        if isinstance(node, Boost):
            return compiled(node.child, targets)
        if isinstance(node, InField):
            return compiled(node.child, [target(s, matcher) for s in searchable_fields(schema, [node.field])])
        if isinstance(node, _Group):
            parts = [c for c in (compiled(child, targets) for child in node.children) if c is not None]
            if not parts:
                return None
            if isinstance(node, AllOf):
                return reduce(and_, parts)
            either = reduce(or_, parts)
            return ~F.coalesce(either, F.lit(False)) if isinstance(node, NoneOf) else either
        return reduce(or_, [node.matches(t, matcher) for t in targets]) if targets else F.lit(False)

    return compiled(text, [target(s, matcher) for s in searchable_fields(schema, fields)])
