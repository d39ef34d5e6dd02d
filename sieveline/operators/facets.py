"""Facet counts.

All facets of a request are counted in one scan and one aggregation: each row
yields one (facet, value) pair per facet it counts for, pairs are pre-aggregated
before the shuffle, and what is left (value texts, top-n, requested values) works
on the counted pairs only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.values import compared, invariant_text, plain_text
from ..schema import FieldSpec, column, require, resolve
from .filters import join_conditions, to_column

# Fixed value: number of facet values where none is asked for.
DEFAULT_SIZE = 10

RESULT_SCHEMA = "agg_pos int, aggregation_id string, value_id string, count bigint"


@dataclass(frozen=True)
class TermFacet:
    """Counts per value of ``field``; without a field, the number of rows under ``filter``.

    ``size`` 0 means all values, ``None`` the default; ``values`` asks for these only.
    """

    field: str | None = None
    id: str | None = None
    size: int | None = None
    values: Sequence[str] | None = None
    filter: object | None = None

    @property
    def result_id(self) -> str | None:
        return self.id if self.id is not None else self.field


@dataclass(frozen=True)
class FacetRange:
    """Half-open range ``[lower, upper)``; a missing bound, or a lower bound of 0, is open."""

    id: str
    lower: str | None = None
    upper: str | None = None


@dataclass(frozen=True)
class RangeFacet:
    field: str
    values: Sequence[FacetRange]
    id: str | None = None
    filter: object | None = None

    @property
    def result_id(self) -> str:
        return (self.id if self.id is not None else self.field).lower()


@dataclass(frozen=True)
class _Entry:
    """One facet made ready: what a row yields, under which condition, and how to finish."""

    position: int
    result_id: str
    guard: Column | None
    values: list[Column]  # text per counted thing, null where the row does not count
    collection: Column | None = None
    data_type: T.DataType | None = None
    size: int = 0
    requested: tuple[str, ...] | None = None
    # Value texts of ``values`` where these are known beforehand.
    labels: tuple[str, ...] | None = None


def _in_range(field: Column, data_type: T.DataType, value: FacetRange) -> Column:
    condition = field.isNotNull()
    if value.lower and value.lower != "0":
        condition = condition & compared(field, ">=", value.lower, data_type)
    if value.upper:
        condition = condition & compared(field, "<", value.upper, data_type)
    return condition


def _entry(position: int, facet: TermFacet | RangeFacet, schema: T.StructType) -> _Entry | None:
    guard = to_column(facet.filter, schema)
    if isinstance(facet, TermFacet) and not facet.field:
        if facet.filter is None or not facet.id:
            return None
        return _Entry(position, facet.id, guard, [F.lit(facet.id)], labels=(facet.id,))
    spec = resolve(schema, facet.field)
    if spec is None:
        return None
    field = column(require(spec, "facetable"))
    if isinstance(facet, RangeFacet):
        ranges = [F.when(_in_range(field, spec.data_type, v), F.lit(v.id)) for v in facet.values]
        labels = tuple(v.id for v in facet.values)
        return _Entry(position, facet.result_id, guard, ranges, labels=labels) if ranges else None
    return _term_entry(position, facet, spec, field, guard)


def _term_entry(
    position: int, facet: TermFacet, spec: FieldSpec, field: Column, guard: Column | None
) -> _Entry:
    requested = None if facet.values is None else tuple(facet.values)
    size = facet.size
    if size is None:
        size = DEFAULT_SIZE if requested is None else 0
    if spec.is_collection:
        return _Entry(
            position, facet.result_id, guard, [], F.array_distinct(field), T.StringType(), size, requested
        )
    value = plain_text(field, spec.data_type)
    if requested is not None and size == 0 and isinstance(spec.data_type, (T.StringType, T.IntegralType)):
        # Only requested values are counted at all.
        value = F.when(F.lower(value).isin([v.lower() for v in requested]), value)
    return _Entry(
        position, facet.result_id, guard, [value], None, spec.data_type, size, requested
    )


def _pair(entry: _Entry, value: Column) -> Column:
    return F.struct(F.lit(entry.position).alias("agg_pos"), value.alias("raw"))


def _guarded(entry: _Entry, value: Column) -> Column:
    return value if entry.guard is None else F.when(entry.guard, value)


def _element_pairs(entry: _Entry) -> Column:
    return F.transform(_guarded(entry, entry.collection), lambda value: _pair(entry, value))


def _pairs(df: DataFrame, entries: list[_Entry]) -> DataFrame:
    """One row (agg_pos, raw value) per counted thing."""
    singles = [_pair(e, _guarded(e, v)) for e in entries for v in e.values]
    if len(singles) == 1 and len(entries) == 1:
        rows = df.select(singles[0].alias("pair"))
    else:
        arrays = [F.array(*singles)] if singles else []
        arrays += [_element_pairs(e) for e in entries if e.collection is not None]
        if len(arrays) > 1:
            nothing = F.array().cast("array<struct<agg_pos:int,raw:string>>")
            arrays = [F.concat(*[F.coalesce(a, nothing) for a in arrays])]
        rows = df.select(F.explode(arrays[0]).alias("pair"))
    return rows.select("pair.agg_pos", "pair.raw").filter(F.col("raw").isNotNull())


def _prefiltered(df: DataFrame, entries: list[_Entry]) -> DataFrame:
    """Rows no facet counts are dropped at the scan."""
    guards = [e.guard for e in entries]
    if any(g is None for g in guards):
        return df
    return df.filter(join_conditions(guards, or_))


def _position_in(entries: list[_Entry]) -> Column:
    return F.col("agg_pos").isin([e.position for e in entries])


def _with_value_texts(counts: DataFrame, entries: list[_Entry]) -> DataFrame:
    text = F.col("raw")
    by_type: dict[str, list[_Entry]] = {}
    for entry in entries:
        if entry.data_type is not None:
            by_type.setdefault(entry.data_type.simpleString(), []).append(entry)
    shown = text
    for same_type in by_type.values():
        converted = invariant_text(text, same_type[0].data_type)
        if converted is not text:
            shown = F.when(_position_in(same_type), converted).otherwise(shown)
    return counts.withColumn("value_id", shown)


def _largest(counts: DataFrame, entries: list[_Entry]) -> DataFrame:
    """Top-n of the facets with a size.

    Pairs of unlimited facets form groups of their own, so no facet with very many
    values ends up in one task; limited groups are cut on the map side already.
    """
    limited = [e for e in entries if e.size]
    if not limited:
        return counts
    limits = F.create_map(*[F.lit(x) for e in limited for x in (e.position, e.size)])
    spread = F.when(~_position_in(limited), F.col("raw"))
    order = Window.partitionBy("agg_pos", spread).orderBy(F.desc("count"), "raw")
    ranked = counts.withColumn("rank", F.row_number().over(order))
    ranked = ranked.filter(F.col("rank") <= max(e.size for e in limited))
    own_limit = F.coalesce(F.try_element_at(limits, F.col("agg_pos")), F.lit(1))
    return ranked.filter(F.col("rank") <= own_limit).drop("rank")


def _requested(counts: DataFrame, entries: list[_Entry]) -> DataFrame:
    """Requested spelling of the best case-insensitive match."""
    asking = [e for e in entries if e.requested is not None]
    if not asking:
        return counts
    spellings: Column = F.array(F.col("value_id"))
    for entry in asking:
        wanted = F.array(*[F.lit(v) for v in entry.requested]).cast("array<string>")
        matching = F.filter(wanted, lambda v: F.lower(v) == F.lower(F.col("value_id")))
        spellings = F.when(F.col("agg_pos") == entry.position, matching).otherwise(spellings)
    free = F.when(~_position_in(asking), F.col("raw"))
    return (
        counts.withColumn("free", free)
        .withColumn("value_id", F.explode(spellings))
        .groupBy("agg_pos", "free", "value_id")
        .agg(F.max("count").alias("count"))
    )


def _entries(schema: T.StructType, requests: Sequence[TermFacet | RangeFacet]) -> list[_Entry]:
    ordered = sorted(requests, key=lambda f: isinstance(f, TermFacet) and not f.field)
    entries = [_entry(i, f, schema) for i, f in enumerate(ordered)]
    return [e for e in entries if e is not None]


def _known_values(entry: _Entry) -> list[tuple[str, Column]]:
    """(value text, what is not null where a row counts) if all values are known before any row is read.

    Requested texts are not: which of several spellings counts is known at the end only.
    """
    if entry.labels is not None:
        return [(label, _guarded(entry, v)) for label, v in zip(entry.labels, entry.values, strict=True)]
    if entry.requested is None or entry.size or not isinstance(entry.data_type, T.IntegralType):
        return []
    text = _guarded(entry, entry.values[0])
    return [(v, F.when(F.lower(text) == v.lower(), text)) for v in dict.fromkeys(entry.requested)]


def known_counts(
    schema: T.StructType, requests: Sequence[TermFacet | RangeFacet]
) -> list[tuple[int, str, str, Column]]:
    """(agg_pos, aggregation_id, value_id, aggregate) of the facets whose values are known beforehand:
    ranges, numbers of rows under a filter, requested whole numbers."""
    return [
        (e.position, e.result_id, label, F.count(value))
        for e in _entries(schema, requests)
        for label, value in _known_values(e)
    ]


def facets(df: DataFrame, requests: Sequence[TermFacet | RangeFacet], unknown_only: bool = False) -> DataFrame:
    """Counts of all requested facets as rows (agg_pos, aggregation_id, value_id, count).

    ``df`` is the text-matched table: a facet counts under its own filter only.
    ``agg_pos`` follows the request order, filter-only facets last. ``unknown_only`` leaves those
    out that ``known_counts`` gives.
    """
    entries = [e for e in _entries(df.schema, requests) if not (unknown_only and _known_values(e))]
    if not entries:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    counts = (
        _pairs(_prefiltered(df, entries), entries)
        .groupBy("agg_pos", "raw")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    counts = _requested(_with_value_texts(_largest(counts, entries), entries), entries)
    names = F.create_map(*[F.lit(x) for e in entries for x in (e.position, e.result_id)])
    return counts.select(
        F.col("agg_pos"), names[F.col("agg_pos")].alias("aggregation_id"), "value_id", "count"
    )


def range_edges(values: Sequence[FacetRange]) -> list[Decimal]:
    """Distinct positive bounds, ascending; bounds that are no numbers are left out."""
    edges = set()
    for bound in (b for v in values for b in (v.lower, v.upper)):
        try:
            edge = Decimal(bound.strip()) if bound else Decimal(0)
        except InvalidOperation:
            continue
        if edge.is_finite() and edge > 0:
            edges.add(edge)
    return sorted(edges)


def bucket_counts(df: DataFrame, field: str, values: Sequence[FacetRange]) -> DataFrame:
    """Counts of the n + 1 adjacent buckets between the n edges: (bucket, lower, upper, count)."""
    schema = "bucket int, lower string, upper string, count bigint"
    spec = resolve(df.schema, field)
    if spec is None:
        return df.sparkSession.createDataFrame([], schema)
    value = column(require(spec, "facetable"))
    edges = [format(e, "f") for e in range_edges(values)]
    reached = [F.when(compared(value, ">=", e, spec.data_type), 1).otherwise(0) for e in edges]
    number = F.when(value.isNotNull(), reduce(add, reached, F.lit(0)))
    bounds = [None, *edges, None]
    rows = [
        F.struct(
            F.lit(i).alias("bucket"),
            F.lit(bounds[i]).cast("string").alias("lower"),
            F.lit(bounds[i + 1]).cast("string").alias("upper"),
            F.col(f"n{i}").alias("count"),
        )
        for i in range(len(edges) + 1)
    ]
    counted = df.select(number.alias("number")).agg(
        *[F.count_if(F.col("number") == i).alias(f"n{i}") for i in range(len(edges) + 1)]
    )
    return counted.select(F.inline(F.array(*rows)))
