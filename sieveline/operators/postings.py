"""Keyword search over a table of tokens instead of the texts.

``build_postings`` turns the searchable fields into rows (field, token, key, tf,
length), one per distinct token of a document's field.  Stored sorted by field and
token, a query reads only the row groups its terms fall into.  Results equal those
of ``search_text`` and ``score`` on the texts themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx
from ..functions.text import Analysis, Fuzzy
from ..schema import KEY, normalize_name
from .matching import folded, searchable_fields
from .scoring import inverse_frequency, term_weight
from .sorting import SCORE

def _field_tokens(df: DataFrame, fields: Sequence[str] | None, keep: Sequence[str], words: tx.Words) -> DataFrame:
    """One row per document and searchable field; ``tokens`` is null where there is no text."""
    texts = [
        F.struct(F.lit(normalize_name(s.name)).alias("field"), folded(s).alias("text"))
        for s in searchable_fields(df.schema, fields)
    ]
    array = F.array(*texts) if texts else F.array().cast("array<struct<field:string,text:string>>")
    rows = df.select(*keep, F.inline_outer(array))
    return rows.select(*keep, "field", tx.tokens(words.prepared(F.col("text")), words).alias("tokens"))


def build_postings(
    df: DataFrame, fields: Sequence[str] | None = None, keep: Sequence[str] = (KEY,), words: tx.Words = tx.LETTERS
) -> DataFrame:
    """Rows (*keep, field, length, token, tf); the last column of ``keep`` is the key.

    The counts are complete before the shuffle, because a document's tokens come
    from one row; if ``df`` is partitioned by one of the ``keep`` columns there is
    no shuffle at all.  A row without a key stays as a row without a token.
    """
    tokens = _field_tokens(df, fields, keep, words)
    exploded = tokens.select(
        *keep, "field", F.size("tokens").alias("length"), F.explode_outer("tokens").alias("token")
    ).filter(F.col("token").isNotNull() | F.col(keep[-1]).isNull())
    return exploded.groupBy(*keep, "field", "length", "token").agg(F.count(F.lit(1)).cast("int").alias("tf"))


def token_keys(df: DataFrame, fields: Sequence[str] | None = None, key: str = KEY, words: tx.Words = tx.LETTERS) -> DataFrame:
    """(token, key): a row per distinct token of a row's field, for lookups that need neither counts nor lengths.

    What ``build_postings`` has in these columns, but made within each row: nothing is shuffled. Rows
    without a token have none here, with or without a key.
    """
    tokens = _field_tokens(df, fields, [key], words)
    return tokens.select(F.explode(F.array_distinct("tokens")).alias("token"), key)


def field_lengths(
    df: DataFrame, fields: Sequence[str] | None = None, by: Sequence[str] = (), words: tx.Words = tx.LETTERS
) -> DataFrame:
    """Filled rows and tokens per field: (*by, field, rows, tokens)."""
    return _field_tokens(df, fields, by, words).groupBy(*by, "field").agg(
        F.count("tokens").alias("rows"), F.sum(F.size("tokens").cast("bigint")).alias("tokens")
    )


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def search_postings(
    postings: DataFrame,
    lengths: DataFrame,
    text: str,
    fields: Sequence[str],
    matcher: Analysis | Fuzzy = Analysis(),
    boosts: Mapping[str, float] | None = None,
    key: str = KEY,
    name: str = SCORE,
) -> DataFrame:
    """(key, score) of the documents that hit every term of ``text`` in some of the fields.

    One aggregation by document over the hit tokens; the number of documents per
    term comes from that same aggregation.
    """
    terms = tx.query_terms(text, matcher.words)
    names = [normalize_name(f) for f in fields]
    if not terms or not names:
        raise ValueError("a search over postings needs terms and fields")
    weights = {term.lower(): weight for term, weight in (boosts or {}).items()}
    token = F.col("token")
    hits = postings.filter(F.col("field").isin(names) & _any([matcher.hits(token, t) for t in terms]))

    counts = []
    for i, field in enumerate(names):
        mine = F.col("field") == field
        counts.append(F.max(F.when(mine, F.col("length"))).alias(f"length_{i}"))
        for j, term in enumerate(terms):
            counts.append(F.sum(F.when(mine & matcher.hits(token, term), F.col("tf"))).alias(f"tf_{i}_{j}"))
    documents = hits.groupBy(key).agg(*counts)

    pairs = [(i, j) for i in range(len(names)) for j in range(len(terms))]
    # The lengths, which say nothing here, keep both readers on the same columns: one scan, one shuffle.
    hit = lambda i, j: F.when(F.col(f"length_{i}").isNotNull(), F.col(f"tf_{i}_{j}"))
    frequencies = documents.agg(*[F.count(hit(i, j)).alias(f"hits_{i}_{j}") for i, j in pairs])
    hit_rows = frequencies.select(F.struct("*").alias("s")).scalar()
    totals = lengths.agg(
        *[F.sum(F.when(F.col("field") == f, F.col(c))).alias(f"{c}_{i}")
          for i, f in enumerate(names) for c in ("rows", "tokens")]
    )
    size = totals.select(F.struct("*").alias("s")).scalar()

    parts = []
    for i, j in pairs:
        rows = size[f"rows_{i}"]
        idf = inverse_frequency(rows, hit_rows[f"hits_{i}_{j}"])
        weight = term_weight(F.col(f"tf_{i}_{j}"), F.col(f"length_{i}"), size[f"tokens_{i}"] / rows)
        factor = F.lit(float(weights.get(terms[j], 1.0)))
        parts.append(F.coalesce(factor * idf * weight, F.lit(0.0)))
    matched = [_any([F.col(f"tf_{i}_{j}").isNotNull() for i in range(len(names))]) for j in range(len(terms))]
    return documents.filter(reduce(and_, matched)).select(key, reduce(add, parts).alias(name))
