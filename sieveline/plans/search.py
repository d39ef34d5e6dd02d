"""One search request over a document table: documents, total and facets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, Row, functions as F

from ..functions.text import Analysis, Fuzzy
from ..operators.facets import RESULT_SCHEMA, RangeFacet, TermFacet, facets, known_counts
from ..operators.filters import RawFilter, apply_filter
from ..operators.query import query_condition
from ..operators.scoring import score
from ..operators.sorting import DEEP_PAGE, SCORE, GeoSort, SortField, page, retrieve, sort_columns, total_count
from ..schema import KEY, resolve

# Fixed value: page length where none is asked for.
DEFAULT_TAKE = 20

# Relevance while a request is answered: no field can have this name.
RELEVANCE = "__score"


@dataclass(frozen=True)
class SearchRequest:
    """What to look for.

    ``text`` is a string, all of whose terms must match, or a tree of ``operators.query``. ``raw`` is
    a Spark SQL predicate that replaces text and filter. ``take=None`` takes all rows after ``skip``.
    ``stats`` is a row of ``corpus_stats`` for the same text, fields and matcher that was kept: it saves
    the pass over the whole table that scores need otherwise.
    """

    text: object | None = None
    fields: Sequence[str] | None = None
    fuzzy: bool = False
    fuzziness: int | None = None
    filter: object | None = None
    sort: Sequence[SortField | GeoSort] = ()
    skip: int = 0
    take: int | None = DEFAULT_TAKE
    facets: Sequence[TermFacet | RangeFacet] = ()
    raw: str | None = None
    use_backup: bool = False
    stats: DataFrame | None = None


@dataclass(frozen=True)
class SearchResult:
    """Three lazy frames; nothing runs before an action on one of them, except that a deep page
    (see ``page``) is ranked at once."""

    documents: DataFrame
    total: DataFrame
    facets: DataFrame


def _text_matched(df: DataFrame, request: SearchRequest, analysis: Analysis) -> DataFrame:
    condition = query_condition(df.schema, request.text, request.fields, _matcher(request, analysis))
    return df if condition is None else df.filter(condition)


def matched(df: DataFrame, request: SearchRequest, analysis: Analysis = Analysis()) -> DataFrame:
    """All rows the request selects, unordered."""
    if request.raw:
        return apply_filter(df, RawFilter(request.raw))
    # The cheap comparisons come first: they reach the reader, and texts are only looked at after them.
    return _text_matched(apply_filter(df, request.filter), request, analysis)


def _matcher(request: SearchRequest, analysis: Analysis) -> Analysis | Fuzzy:
    return Fuzzy(request.fuzziness, words=analysis.words) if request.fuzzy else analysis


def _documents(df: DataFrame, hits: DataFrame, request: SearchRequest, analysis: Analysis, key: str) -> DataFrame:
    text = None if request.raw else request.text

    def scored(rows: DataFrame) -> DataFrame:
        return score(rows, text, request.fields, _matcher(request, analysis), corpus=df, stats=request.stats, name=RELEVANCE)

    own_score = resolve(df.schema, SCORE)
    by_field = sort_columns(request.sort, df.schema)
    wants_relevance = own_score is None and any(isinstance(k, SortField) and k.field == SCORE for k in request.sort)
    if by_field and not wants_relevance:
        # Only the rows of the page are scored.
        rows = scored(page(hits, request.skip, request.take, [*by_field, F.col(key).asc()]))
    else:
        hits = scored(hits)
        order = sort_columns(request.sort, hits.schema, RELEVANCE) or [F.desc(RELEVANCE)]
        rows = page(hits, request.skip, request.take, [*order, F.col(key).asc()])
    found = retrieve(rows, extra=(RELEVANCE,))
    # A field of that name stays as it is; the relevance then keeps the inner name.
    return found if SCORE in found.columns else found.withColumnRenamed(RELEVANCE, SCORE)


def search(
    df: DataFrame, request: SearchRequest, analysis: Analysis = Analysis(), key: str = KEY
) -> SearchResult:
    """Text and filter, then sort, page and projection; total over all matches.

    Facets count under the text and their own filters, not the main filter.
    Without a sort, rows come by score, then key. The relevance is returned as ``score``; where
    the table has a field of that name, which then also is what a sort by ``score`` means, as
    ``__score``.
    """
    if request.raw:
        total = df.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("total"))
    else:
        total = total_count(matched(df, request, analysis))
    found = _text_matched(df, request, analysis)
    hits = matched(df, request, analysis)
    return SearchResult(_documents(df, hits, request, analysis, key), total, facets(found, request.facets))


@dataclass(frozen=True)
class Answer:
    """A page of documents, the number of all matches, and facet counts
    (agg_pos, aggregation_id, value_id, count), on the driver."""

    documents: list[Row]
    total: int | None
    facets: list[Row]


def answer(df: DataFrame, request: SearchRequest, analysis: Analysis = Analysis(), key: str = KEY) -> Answer:
    """The rows of :func:`search`, asked at once: total and facets are counted while the page is found.

    One scan gives the page, the total, and the facets whose values are known beforehand (ranges,
    numbers of rows under a filter, requested whole numbers); other facets take an aggregation of
    their own, and scores without ``stats`` the pass for the corpus figures. The page comes to the
    driver, so it needs a ``take`` and ends within :data:`DEEP_PAGE` rows. Sorting a page takes no
    shuffle, so each partition is counted once, however often a lost executor makes it run again.
    Where the page is empty, the figures come from the frames of :func:`search`.
    """
    if request.take is None or request.skip + request.take > DEEP_PAGE:
        raise ValueError(f"an answer is a page that ends within {DEEP_PAGE} rows")
    # A raw predicate selects other rows than those that facets count.
    known = [] if request.raw else known_counts(df.schema, request.facets)
    facets_seen, total_seen = Observation(), Observation()
    if known:
        counted = [aggregate.alias(f"n{i}") for i, (*_, aggregate) in enumerate(known)]
        # Facets count outside of the main filter too, which therefore comes after them.
        hits = apply_filter(_text_matched(df, request, analysis).observe(facets_seen, *counted), request.filter)
    else:
        hits = matched(df, request, analysis)
    hits = hits.observe(total_seen, F.count(F.lit(1)).alias("total"))
    rows = _documents(df, hits, replace(request, take=max(request.take, 1)), analysis, key).collect()
    if not rows:
        # What cannot have rows may be answered without reading any: nothing was counted on the way.
        wanted = search(df, request, analysis, key)
        return Answer([], wanted.total.first().total, wanted.facets.collect())
    counts: dict[tuple, int] = {}
    for i, (*place, _) in enumerate(known):
        counts[tuple(place)] = counts.get(tuple(place), 0) + facets_seen.get[f"n{i}"]
    row = Row("agg_pos", "aggregation_id", "value_id", "count")
    listed = [row(*place, n) for place, n in counts.items() if n]
    if len({position for position, *_ in known}) < len(request.facets):
        listed += facets(_text_matched(df, request, analysis), request.facets, unknown_only=bool(known)).collect()
    total = None if request.raw else total_seen.get["total"]
    return Answer(rows[: request.take], total, sorted(listed, key=lambda r: r.agg_pos))


def empty_result(spark) -> SearchResult:
    """Answer of an index that does not exist yet."""
    return SearchResult(
        spark.createDataFrame([], "id string, score double"),
        spark.range(1).select(F.lit(0).cast("bigint").alias("total")),
        spark.createDataFrame([], RESULT_SCHEMA),
    )
