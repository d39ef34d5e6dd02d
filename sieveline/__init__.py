"""Document search and faceting over Spark tables."""

from .functions.geo import geo_distance, geo_point
from .functions.text import LETTERS, STANDARD_WORDS, Analysis, Fuzzy
from .operators.facets import FacetRange, RangeFacet, TermFacet, bucket_counts, facets
from .operators.filters import (
    And,
    GeoDistance,
    Ids,
    Not,
    Or,
    Range,
    RangeValue,
    RawFilter,
    Term,
    apply_filter,
    to_column,
)
from .operators.matching import field_match, search_text, suggest
from .operators.query import AllOf, AnyOf, Boost, InField, Match, Near, NearAll, NoneOf, Phrase, Regex, Wildcard
from .operators.scoring import corpus_stats, score
from .operators.sorting import GeoSort, SortField, page, retrieve, sort, total_count
from .plans.search import Answer, SearchRequest, SearchResult, answer, search
from .schema import KEY, FieldError, FieldSpec, normalize_columns, normalize_name, with_flags
from .sources.index import DocumentIndex

__all__ = [
    "Answer",
    "answer",
    "KEY",
    "LETTERS",
    "STANDARD_WORDS",
    "AllOf",
    "Analysis",
    "And",
    "AnyOf",
    "Boost",
    "DocumentIndex",
    "FacetRange",
    "FieldError",
    "FieldSpec",
    "Fuzzy",
    "GeoDistance",
    "GeoSort",
    "Ids",
    "InField",
    "Match",
    "Near",
    "NearAll",
    "NoneOf",
    "Not",
    "Or",
    "Phrase",
    "Range",
    "RangeFacet",
    "RangeValue",
    "RawFilter",
    "Regex",
    "SearchRequest",
    "SearchResult",
    "SortField",
    "Term",
    "TermFacet",
    "Wildcard",
    "apply_filter",
    "bucket_counts",
    "corpus_stats",
    "facets",
    "field_match",
    "geo_distance",
    "geo_point",
    "normalize_columns",
    "normalize_name",
    "page",
    "retrieve",
    "score",
    "search",
    "search_text",
    "sort",
    "suggest",
    "to_column",
    "total_count",
    "with_flags",
]
