"""Keyword and fuzzy search over the searchable fields of a table, and suggestions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import text as tx
from ..functions.text import Analysis, Fuzzy
from ..schema import FieldError, FieldSpec, column, require, resolve, specs_of


def searchable_fields(schema: T.StructType, fields: Sequence[str] | None = None) -> list[FieldSpec]:
    """The requested (known) searchable fields; all of them by default."""
    if fields is None:
        return [s for s in specs_of(schema) if s.searchable]
    known = [resolve(schema, name) for name in fields]
    return [require(s, "searchable") for s in known if s is not None]


def folded(spec: FieldSpec) -> Column:
    return tx.fold(column(spec), spec.data_type)


def target(spec: FieldSpec, matcher: Analysis | Fuzzy) -> Column:
    """The text of a field as a matcher takes it."""
    return matcher.words.prepared(folded(spec))


def text_condition(
    schema: T.StructType,
    text: str | None,
    fields: Sequence[str] | None = None,
    matcher: Analysis | Fuzzy = Analysis(),
) -> Column | None:
    """Every term must hit in some searchable field; ``None`` when there is no term."""
    terms = tx.query_terms(text, matcher.words)
    if not terms:
        return None
    targets = [target(s, matcher) for s in searchable_fields(schema, fields)]
    if not targets:
        return F.lit(False)
    return reduce(and_, [reduce(or_, [matcher.matches(t, term) for t in targets]) for term in terms])


def search_text(
    df: DataFrame,
    text: str | None,
    fields: Sequence[str] | None = None,
    matcher: Analysis | Fuzzy = Analysis(),
) -> DataFrame:
    """Rows that match all terms of ``text``; all rows for a blank text."""
    terms = tx.query_terms(text, matcher.words)
    specs = searchable_fields(df.schema, fields) if terms else []
    if not (specs and matcher.words.standard and isinstance(matcher, Analysis)):
        condition = text_condition(df.schema, text, fields, matcher)
        return df if condition is None else df.filter(condition)
    # Tokens are parts of the folded text: only a text that holds the terms is cut into tokens, and as
    # output of a generator it is cut once, however many terms look at it.
    held = [reduce(or_, [F.contains(folded(s), F.lit(t)) for s in specs]) for t in terms]
    names = [f"__tokens_{i}" for i in range(len(specs))]
    cut = F.inline(F.array(F.struct(*[target(s, matcher).alias(n) for s, n in zip(specs, names)])))
    hits = [reduce(or_, [matcher.matches(F.col(n), t) for n in names]) for t in terms]
    return df.filter(reduce(and_, held)).select("*", cut).filter(reduce(and_, hits)).drop(*names)


def field_match(
    df: DataFrame, field: str, matcher: Callable[..., Column], *args, **options
) -> DataFrame:
    """Rows where one field passes a matcher of ``functions.text``; none for an unknown field."""
    spec = resolve(df.schema, field)
    if spec is None:
        return df.filter(F.lit(False))
    words = options.get("words", tx.LETTERS)
    return df.filter(matcher(words.prepared(folded(require(spec, "searchable"))), *args, **options))


def suggest(df: DataFrame, query: str | None, fields: Sequence[str], size: int = 5) -> DataFrame:
    """Up to ``size`` distinct field texts that complete the query, in text order.

    The last term is a prefix of some token, the terms before it are whole tokens.
    """
    terms = tx.query_terms(query)
    known = [s for s in (resolve(df.schema, name) for name in fields or ()) if s is not None]
    known = [require(s, "suggestable") for s in known]
    if not terms or not known:
        return df.sparkSession.createDataFrame([], "text string")
    if any(not s.is_text for s in known):
        raise FieldError("suggestions need text fields")

    def completes(value: Column) -> Column:
        target = tx.fold(value)
        last = tx.prefix_match(target, terms[-1], 1, len(terms[-1]))
        return reduce(and_, [tx.word_match(target, t) for t in terms[:-1]] + [last])

    # A field's text is only carried on where it matches, so the explode stays narrow.
    candidates = [
        F.filter(column(s), completes)
        if s.is_collection
        else F.when(completes(column(s)), F.array(column(s)))
        for s in known
    ]
    nothing = F.array().cast("array<string>")
    texts = F.concat(*[F.coalesce(c, nothing) for c in candidates])
    return (
        df.select(F.explode(texts).alias("text")).distinct().orderBy("text").limit(size)
    )
