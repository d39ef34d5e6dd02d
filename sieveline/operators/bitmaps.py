"""Facets from bitmaps: counts under many filters without reading the documents again.

Documents get row numbers once. A table then holds, per field, value and block of 32768 row numbers,
a bitmap of the rows that have the value. A filter is a few of these bitmaps, joined by "or" within a
field and by "and" over fields, block by block; a facet's counts are the bits that are left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field as default
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.values import invariant_text, plain_text
from ..schema import KEY, FieldError, column, normalize_name, require, resolve
from .ranking import ranked

ROW = "__row"


@dataclass(frozen=True)
class BitmapFacet:
    """Counts per value of ``field`` among the rows that ``where`` selects: per field some values, of
    which a row has at least one. An empty list of values selects every row, as in a term filter."""

    field: str
    id: str | None = None
    where: Mapping[str, Sequence[str]] = default(default_factory=dict)

    @property
    def result_id(self) -> str:
        return self.id if self.id is not None else self.field


def numbered(df: DataFrame, fields: Sequence[str], key: str = KEY) -> DataFrame:
    """``key``, the fields and the row number ``__row``, from 0 in the order of the key.

    Only these columns are sorted, each range of the order by itself.
    """
    names = [_facetable(df, f).name for f in fields]
    return ranked(df.select(key, *[F.col(f"`{n}`") for n in names if n != key]), [F.col(key)], ROW)


def _facetable(df: DataFrame, name: str):
    spec = resolve(df.schema, name)
    if spec is None:
        raise FieldError(f"there is no field {name!r}")
    return require(spec, "facetable")


def _value_texts(df: DataFrame, name: str) -> Column:
    """(field, value) of each value that a row has in a field."""
    spec = _facetable(df, name)
    if spec.is_collection:
        texts = F.array_distinct(column(spec))
    else:
        texts = F.array(invariant_text(plain_text(column(spec), spec.data_type), spec.data_type))
    stored = F.lit(normalize_name(spec.name))
    pairs = F.transform(texts, lambda v: F.struct(stored.alias("field"), v.alias("value")))
    return F.coalesce(pairs, F.array().cast("array<struct<field:string,value:string>>"))


def facet_bitmaps(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``field, value, block, bits`` of numbered rows; write it sorted by ``field`` and ``value``.

    Made for fields with few values: a value takes up to 4 KB for each block it occurs in. Null is no
    value; a text that a collection repeats counts once per row. One aggregation, combined before its
    shuffle: as rows are numbered in order, a task meets few blocks.
    """
    # Bits count from 1.
    number = F.col(ROW) + 1
    pairs = rows.select(number.alias("n"), F.inline(F.concat(*[_value_texts(rows, f) for f in fields]))).filter(F.col("value").isNotNull())
    return pairs.groupBy("field", "value", F.bitmap_bucket_number("n").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")
    )


def merge_bitmaps(first: DataFrame, second: DataFrame) -> DataFrame:
    """The bitmaps of two sets of rows of one numbering."""
    both = first.unionByName(second)
    return both.groupBy("field", "value", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def selected(bitmaps: DataFrame, where: Mapping[str, Sequence[str]]) -> DataFrame | None:
    """``block, chosen``: the rows that have one of the values in every field; ``None`` for all rows."""
    parts = [
        bitmaps.filter((F.col("field") == normalize_name(name)) & F.col("value").isin(list(values)))
        .groupBy("block")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
        for name, values in where.items()
        if values
    ]
    if not parts:
        return None
    # A block that some field lacks has no row that has them all.
    together = reduce(DataFrame.unionByName, parts).groupBy("block")
    found = together.agg(F.bitmap_and_agg("bits").alias("chosen"), F.count(F.lit(1)).alias("fields"))
    return found.filter(F.col("fields") == len(parts)).drop("fields")


def selected_total(bitmaps: DataFrame, where: Mapping[str, Sequence[str]]) -> DataFrame:
    """``total``: the number of rows that ``where`` selects; it must name some value."""
    chosen = selected(bitmaps, where)
    if chosen is None:
        raise FieldError("a total needs a selection")
    return chosen.agg(F.coalesce(F.sum(F.bitmap_count("chosen")), F.lit(0)).cast("long").alias("total"))


def bitmap_facets(bitmaps: DataFrame, wanted: Sequence[BitmapFacet]) -> DataFrame:
    """``agg_pos, aggregation_id, value_id, count``, as ``facets`` gives them for term facets of size 0.

    Only bitmaps of the fields in use are read, and a bitmap is never larger than 4 KB, so no value is
    a hot spot. Facets under one selection share its plan.
    """
    found = []
    for position, facet in enumerate(wanted):
        own = bitmaps.filter(F.col("field") == normalize_name(facet.field)).select("value", "block", "bits")
        chosen = selected(bitmaps, facet.where)
        if chosen is not None:
            pair = own.join(chosen, "block").select("value", "block", F.explode(F.array("bits", "chosen")).alias("bits"))
            own = pair.groupBy("value", "block").agg(F.bitmap_and_agg("bits").alias("bits"))
        counts = own.groupBy("value").agg(F.sum(F.bitmap_count("bits")).cast("long").alias("count")).filter("count > 0")
        found.append(
            counts.select(
                F.lit(position).cast(T.IntegerType()).alias("agg_pos"),
                F.lit(facet.result_id).alias("aggregation_id"),
                F.col("value").alias("value_id"),
                "count",
            )
        )
    if not found:
        return bitmaps.sparkSession.createDataFrame([], "agg_pos int, aggregation_id string, value_id string, count bigint")
    return reduce(DataFrame.unionByName, found)
