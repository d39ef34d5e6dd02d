"""Sorting, paging and the columns that are returned."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import geo
from ..functions.values import utc_time
from ..schema import KEY, column, external_name, normalize_name, require, resolve, specs_of
from .filters import location
from .ranking import ranked

SCORE = "score"
# Rows that a top-k may gather; a deeper page is found by ranks.
DEEP_PAGE = 100_000


@dataclass(frozen=True)
class SortField:
    field: str
    descending: bool = False


@dataclass(frozen=True)
class GeoSort:
    field: str
    lat: float
    lon: float
    descending: bool = False


def _sort_value(key: SortField | GeoSort, schema: T.StructType, score: str) -> Column | None:
    if isinstance(key, GeoSort):
        place = location(schema, key.field)
        return None if place is None else geo.haversine_km(place[0], place[1], key.lat, key.lon)
    spec = resolve(schema, key.field)
    if spec is None:
        return F.col(score) if key.field == SCORE and score in schema.names else None
    return column(require(spec, "sortable"))


def sort_columns(
    keys: Sequence[SortField | GeoSort], schema: T.StructType, score: str = SCORE
) -> list[Column]:
    """Sort expressions of the known fields; unknown ones and repetitions are left out.

    Nulls come first in ascending and last in descending order.
    """
    expressions = []
    for key in dict.fromkeys(_same_field(k) for k in keys):
        value = _sort_value(key, schema, score)
        if value is not None:
            expressions.append(value.desc() if key.descending else value.asc())
    return expressions


def _same_field(key: SortField | GeoSort) -> SortField | GeoSort:
    """Spellings of one field name sort alike."""
    name = normalize_name(key.field)
    if isinstance(key, GeoSort):
        return GeoSort(name, key.lat, key.lon, key.descending)
    return SortField(key.field if key.field == SCORE else name, key.descending)


def sort(
    df: DataFrame, keys: Sequence[SortField | GeoSort], tie_break: Sequence[str] = (KEY,)
) -> DataFrame:
    """Order by the keys; the unique ``tie_break`` columns make the order total."""
    known = [F.col(c) for c in tie_break if c in df.columns]
    expressions = sort_columns(keys, df.schema)
    return df.orderBy(*expressions, *known) if expressions or known else df


def page(df: DataFrame, skip: int = 0, take: int | None = None, order: Sequence[Column] = ()) -> DataFrame:
    """Rows ``skip`` to ``skip + take`` of an ordered frame, or of a frame and its ``order``.

    Up to :data:`DEEP_PAGE` rows this is a distributed top-k. Beyond that, and for a skip without a
    take, ``order`` is needed: rows are ranked range by range, so that no task and not the
    driver takes all rows before the page. That writes the ranges to the shared folder at once.
    """
    if skip + (take or 0) > DEEP_PAGE or (skip and take is None):
        if not order:
            raise ValueError("a deep skip, or a skip without a take, needs the order")
        position = F.col("__position")
        ranks = ranked(df, list(order), "__position").filter(position >= skip)
        if take is not None:
            ranks = ranks.filter(position < skip + take)
        return ranks.orderBy("__position").drop("__position")
    if order:
        df = df.orderBy(*order)
    if skip:
        df = df.offset(skip)
    return df if take is None else df.limit(take)


def total_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def retrieve(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Retrievable columns only, the key as ``id``, instants as UTC date-times.

    ``extra`` names columns that are kept as they are (such as the score).
    """
    columns = []
    for spec in specs_of(df.schema):
        if spec.name in extra:
            columns.append(column(spec))
        elif spec.is_key:
            columns.append(column(spec).alias("id"))
        elif spec.retrievable:
            columns.append(utc_time(column(spec), spec.data_type).alias(external_name(normalize_name(spec.name))))
    return df.select(*columns)
