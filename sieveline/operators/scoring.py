"""BM25 relevance (Robertson and Zaragoza) of rows for a query text.

Term frequencies are counted per row on the folded text.  Corpus figures (number
of rows, mean length, rows per term) come from one global aggregate, which
``score`` reads as a scalar subquery: documents are neither shuffled nor joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx
from ..functions.text import Analysis, Fuzzy
from ..schema import FieldSpec, column
from .matching import searchable_fields, target
from .query import Unit, units
from .sorting import SCORE

K1 = 1.2
B = 0.75


def corpus_stats(
    df: DataFrame, text, fields: Sequence[str] | None = None, matcher: Analysis | Fuzzy = Analysis()
) -> DataFrame:
    """One row: per field the filled rows and mean length, per field and query leaf the rows hit."""
    leaves = units(text, words=matcher.words)
    figures = []
    targets = searchable_fields(df.schema, fields)
    # A text is prepared once per row, however many figures look at it.
    df = df.select("*", *[target(s, matcher).alias(f"__text_{i}") for i, s in enumerate(targets)])
    for i, spec in enumerate(targets):
        text_i = F.col(f"__text_{i}")
        figures.append(F.count(column(spec)).alias(f"rows_{i}"))
        figures.append(F.avg(tx.token_count(text_i, matcher.words)).alias(f"length_{i}"))
        for j, unit in enumerate(leaves):
            if unit.in_field(spec):
                figures.append(F.count_if(unit.leaf.matches(text_i, matcher)).alias(f"hits_{i}_{j}"))
    return df.agg(*figures)


def inverse_frequency(rows: Column, hits: Column) -> Column:
    return F.log(F.lit(1.0) + (rows - hits + F.lit(0.5)) / (hits + F.lit(0.5)))


def term_weight(tf: Column, length: Column, mean_length: Column) -> Column:
    """Weight of a term; 0 where it does not occur, null where there is no text at all."""
    norm = F.lit(1 - B) + F.lit(B) * length / F.when(mean_length > 0, mean_length)
    return tf * F.lit(K1 + 1) / (tf + F.lit(K1) * norm)


def _counts(fields: list[FieldSpec], leaves: list[Unit], matcher: Analysis | Fuzzy) -> Column:
    """Struct of the token count per field and the hits per field and leaf."""
    counts = []
    for i, spec in enumerate(fields):
        text_i = F.col(f"__text_{i}")
        counts.append(tx.token_count(text_i, matcher.words).alias(f"__length_{i}"))
        counts += [
            unit.leaf.frequency(text_i, matcher).alias(f"__tf_{i}_{j}")
            for j, unit in enumerate(leaves)
            if unit.in_field(spec)
        ]
    return F.struct(*counts)


def _field_score(i: int, spec: FieldSpec, leaves: list[Unit], stats: Column) -> Column:
    parts = [F.lit(0.0)]
    for j, unit in enumerate(leaves):
        if unit.in_field(spec):
            idf = inverse_frequency(stats[f"rows_{i}"], stats[f"hits_{i}_{j}"])
            weight = term_weight(F.col(f"__tf_{i}_{j}"), F.col(f"__length_{i}"), stats[f"length_{i}"])
            parts.append(F.lit(unit.weight) * idf * weight)
    return reduce(add, parts)


def score(
    df: DataFrame,
    text,
    fields: Sequence[str] | None = None,
    matcher: Analysis | Fuzzy = Analysis(),
    boosts: Mapping[str, float] | None = None,
    corpus: DataFrame | None = None,
    stats: DataFrame | None = None,
    name: str = SCORE,
) -> DataFrame:
    """Add the relevance of each row for a text or a query tree; 1.0 where nothing is scored.

    ``corpus`` is the whole table the figures are taken over (default ``df``
    itself); pass it when ``df`` is already filtered.  ``stats`` is a row of
    ``corpus_stats`` for the same text and fields that was kept, which saves the
    pass over the corpus.  ``boosts`` maps a term to the factor of its contribution.
    """
    leaves = units(text, boosts, matcher.words)
    corpus = df if corpus is None else corpus
    targets = searchable_fields(df.schema, fields)
    if not leaves or not targets:
        return df.withColumn(name, F.lit(1.0))
    if stats is None:
        stats = corpus_stats(corpus, text, fields, matcher)
    figures = stats.select(F.struct("*").alias("s")).scalar()
    parts = [_field_score(i, spec, leaves, figures) for i, spec in enumerate(targets)]
    # A row without the field has a null length: it adds nothing.
    total = reduce(add, [F.coalesce(p, F.lit(0.0)) for p in parts])
    # The counts are used several times each.  As output of a generator they are
    # computed once per row; as plain columns the optimizer would copy them into the sum.
    texts = df.select("*", *[target(s, matcher).alias(f"__text_{i}") for i, s in enumerate(targets)])
    counted = texts.select("*", F.inline(F.array(_counts(targets, leaves, matcher))))
    return counted.select(*[F.col(f"`{c}`") for c in df.columns if c != name], total.alias(name))
