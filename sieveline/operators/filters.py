"""Filter trees compiled to one boolean ``Column``.

``to_column`` returns ``None`` for "no restriction".  Logic is two-valued: a
comparison with null is false, so its negation is true.  Positive leaves stay
plain comparisons, and negation is carried down to the leaves, so both kinds
reach the Parquet reader.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce, singledispatch
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import geo
from ..functions.values import can_equal, compared, typed_literal
from ..schema import KEY, KEY_OF, FieldError, column, require, resolve
from ..sizing import broadcast_if_small


@dataclass(frozen=True)
class Ids:
    values: Sequence[str | None] | None


@dataclass(frozen=True)
class Term:
    field: str
    values: Sequence[str | None]


@dataclass(frozen=True)
class RangeValue:
    lower: str | None = None
    upper: str | None = None
    include_lower: bool = False
    include_upper: bool = False


@dataclass(frozen=True)
class Range:
    field: str
    values: Sequence[RangeValue]


@dataclass(frozen=True)
class GeoDistance:
    """``field`` is a point, or stands for the two columns ``<field>_lat`` and ``<field>_lon``."""

    field: str
    lat: float
    lon: float
    km: float


@dataclass(frozen=True)
class Not:
    child: object | None


@dataclass(frozen=True)
class And:
    children: Sequence[object | None] | None


@dataclass(frozen=True)
class Or:
    children: Sequence[object | None] | None


@dataclass(frozen=True)
class RawFilter:
    """Spark SQL predicate over the table's columns."""

    expression: str


@singledispatch
def compile_filter(node, schema: T.StructType, negate: bool) -> Column | None:
    """Extension point: register a function for a further filter class."""
    raise TypeError(f"not a filter: {node!r}")


def to_column(node, schema: T.StructType, strict: bool = False) -> Column | None:
    """Condition of a filter tree, ``None`` for no restriction (``strict`` refuses that)."""
    condition = None if node is None else compile_filter(node, schema, False)
    if strict and condition is None:
        raise ValueError("the filter restricts nothing")
    return condition


def apply_filter(df: DataFrame, node, strict: bool = False) -> DataFrame:
    condition = to_column(node, df.schema, strict)
    return df if condition is None else df.filter(condition)


def filter_by_keys(df: DataFrame, keys: DataFrame, key: str = KEY) -> DataFrame:
    """Ids filter for a list of keys too long for literals: a semi join."""
    wanted = keys.select(key).distinct()
    return df.join(broadcast_if_small(wanted), key, "left_semi")


def join_conditions(conditions: Sequence[Column | None], combine) -> Column | None:
    present = [c for c in conditions if c is not None]
    return reduce(combine, present) if present else None


def _unknown_field(negate: bool) -> Column:
    return F.lit(negate)


def _negated(condition: Column, *operands: Column) -> Column:
    """Two-valued negation of a comparison over ``operands``."""
    return reduce(or_, [o.isNull() for o in operands] + [~condition])


def _equals_any(field: Column, literals: list[Column], negate: bool) -> Column:
    if len(literals) == 1:
        return ~field.eqNullSafe(literals[0]) if negate else field == literals[0]
    condition = field.isin(literals)
    return _negated(condition, field) if negate else condition


@compile_filter.register
def _(node: Ids, schema: T.StructType, negate: bool) -> Column | None:
    if node.values is None:
        return None
    values = [v for v in node.values if v]
    source = schema[KEY].metadata.get(KEY_OF) if KEY in schema.names else None
    if not values or source not in schema.names or not isinstance(schema[source].dataType, T.IntegralType):
        return compile_filter(Term(KEY, values), schema, negate)
    # The key is the text of a whole-number column: compared as numbers, the ids reach the reader.
    numbers = dict.fromkeys(v for v in values if re.fullmatch(r"0|-?[1-9][0-9]*", v))
    literals = [typed_literal(v, schema[source].dataType) for v in numbers]
    return _equals_any(F.col(f"`{source}`"), literals, negate) if literals else _unknown_field(negate)


@compile_filter.register
def _(node: Term, schema: T.StructType, negate: bool) -> Column | None:
    spec = resolve(schema, node.field)
    if spec is None:
        return _unknown_field(negate)
    values = list(dict.fromkeys(v for v in node.values if v))
    if not values:
        return None
    field = column(require(spec, "filterable"))
    if spec.is_collection:
        overlap = F.arrays_overlap(field, F.array(*[F.lit(v) for v in values]))
        return ~F.coalesce(overlap, F.lit(False)) if negate else overlap
    literals = [typed_literal(v, spec.data_type) for v in values if can_equal(v, spec.data_type)]
    return _equals_any(field, literals, negate) if literals else _unknown_field(negate)


def range_condition(field: Column, data_type: T.DataType, value: RangeValue) -> Column | None:
    bounds = []
    if value.lower:
        bounds.append(compared(field, ">=" if value.include_lower else ">", value.lower, data_type))
    if value.upper:
        bounds.append(compared(field, "<=" if value.include_upper else "<", value.upper, data_type))
    return join_conditions(bounds, and_)


@compile_filter.register
def _(node: Range, schema: T.StructType, negate: bool) -> Column | None:
    spec = resolve(schema, node.field)
    if spec is None:
        return _unknown_field(negate)
    field = column(require(spec, "filterable"))
    condition = join_conditions(
        [range_condition(field, spec.data_type, v) for v in node.values], or_
    )
    if condition is None or not negate:
        return condition
    return _negated(condition, field)


def location(schema: T.StructType, name: str) -> tuple[Column, Column] | None:
    """Latitude and longitude."""
    spec = resolve(schema, name)
    if spec is not None:
        if not geo.is_point(spec.data_type):
            raise FieldError(f"field {spec.name!r} is not a point")
        point = column(spec)
        return geo.latitude(point), geo.longitude(point)
    pair = [resolve(schema, f"{name}_{axis}") for axis in ("lat", "lon")]
    if None in pair:
        return None
    return column(pair[0]), column(pair[1])


@compile_filter.register
def _(node: GeoDistance, schema: T.StructType, negate: bool) -> Column | None:
    place = location(schema, node.field)
    if place is None:
        return _unknown_field(negate)
    lat, lon = place
    near = geo.haversine_km(lat, lon, node.lat, node.lon) <= F.lit(float(node.km))
    if negate:
        return _negated(near, lat, lon)
    # Comparisons first: the reader can use them on columns, and distances are only worked out inside.
    return geo.within_box(lat, lon, node.lat, node.lon, node.km) & near


@compile_filter.register
def _(node: Not, schema: T.StructType, negate: bool) -> Column | None:
    return None if node.child is None else compile_filter(node.child, schema, not negate)


def _compile_children(children, schema: T.StructType, negate: bool) -> list[Column | None]:
    return [compile_filter(c, schema, negate) for c in children or () if c is not None]


@compile_filter.register
def _(node: And, schema: T.StructType, negate: bool) -> Column | None:
    return join_conditions(_compile_children(node.children, schema, negate), or_ if negate else and_)


@compile_filter.register
def _(node: Or, schema: T.StructType, negate: bool) -> Column | None:
    return join_conditions(_compile_children(node.children, schema, negate), and_ if negate else or_)


@compile_filter.register
def _(node: RawFilter, schema: T.StructType, negate: bool) -> Column | None:
    condition = F.expr(node.expression)
    return ~F.coalesce(condition, F.lit(False)) if negate else condition
