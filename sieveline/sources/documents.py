"""From loosely typed documents to a typed table.

The *long form* holds one row per field of a document: ``doc_id``, ``seq`` (place
of the document in its batch), ``name``, ``type`` (a key of ``VALUE_TYPES``),
``values`` (texts) and the field's flags.  Everything here is narrow, or one
aggregation over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.geo import parse_point
from ..schema import (
    KEY,
    KEY_OF,
    SUGGEST_SUFFIX,
    TYPE_NAMES,
    VALUE_TYPES,
    FieldError,
    FieldSpec,
    normalize_name_column,
    type_name,
)

FLAG_DEFAULTS = {
    "searchable": False,
    "filterable": True,
    "retrievable": True,
    "suggestable": False,
    "collection": False,
}

# Columns beside the fields of a document: no field can have these names.
SEQ, PRESENT = "__seq", "__present"


class TypeMismatch(ValueError):
    """A document carries a value whose type does not fit the field."""


def read_documents(df: DataFrame) -> DataFrame:
    """Long form of a batch in canonical columns; flags that are not given get defaults."""
    flags = [
        F.coalesce(F.col(f), F.lit(d)).alias(f) if f in df.columns else F.lit(d).alias(f)
        for f, d in FLAG_DEFAULTS.items()
    ]
    return df.select(
        F.col("doc_id").cast("string"),
        F.col("seq").cast("long"),
        F.col("name").cast("string"),
        F.col("type").cast("string"),
        F.col("values").cast("array<string>"),
        *flags,
    )


@dataclass(frozen=True)
class FieldOf:
    """How one column of a wide frame becomes a field: values, value type and flags."""

    values: Column
    type: str | Column = "String"
    searchable: bool = False
    filterable: bool = True
    retrievable: bool = True
    suggestable: bool = False
    collection: bool = False


def to_long(df: DataFrame, doc_id: Column, seq: Column, fields: Mapping[str, FieldOf]) -> DataFrame:
    """Unpivot a wide frame into the long form: one pass, no shuffle."""
    rows = [
        F.struct(
            F.lit(name).alias("name"),
            (F.lit(f.type) if isinstance(f.type, str) else f.type).alias("type"),
            f.values.cast("array<string>").alias("values"),
            *[F.lit(getattr(f, flag)).alias(flag) for flag in FLAG_DEFAULTS],
        )
        for name, f in fields.items()
    ]
    exploded = df.select(
        doc_id.cast("string").alias("doc_id"), seq.cast("long").alias("seq"), F.inline(F.array(*rows))
    )
    return exploded.filter(F.col("values").isNotNull())


def with_key(df: DataFrame, id_col: str) -> DataFrame:
    """Add the key column ``__id`` unless the table has one. It remembers the column it was made of."""
    if KEY in df.columns:
        return df
    return df.withColumn(KEY, F.col(id_col).cast("string")).withMetadata(KEY, {KEY_OF: id_col})


def complex_to_json(value: Column) -> Column:
    """JSON text of a complex value without its nulls."""
    return F.to_json(value, {"ignoreNullFields": "true"})


def merge_duplicate_fields(long: DataFrame) -> DataFrame:
    """One row per document and normalised name: (doc_id, seq, field, values).

    Fields that collide are visited in raw-name order; the first one gives its
    value (all values of a collection), each later one adds all its values.
    """
    part = F.struct("name", F.col("collection"), F.col("values"))
    own = lambda p: F.when(p["collection"], p["values"]).otherwise(F.slice(p["values"], 1, 1))
    parts = F.array_sort(F.collect_list(part))
    merged = F.flatten(
        F.transform(parts, lambda p, i: F.when(i > 0, p["values"]).otherwise(own(p)))
    )
    return (
        long.withColumn("field", normalize_name_column(F.col("name")))
        .groupBy("doc_id", "seq", "field")
        .agg(merged.alias("values"))
    )


def _storage_type(value_type: Column, collection: Column) -> Column:
    """Column type of a value type; an unknown one raises when it is met."""
    names = F.create_map(*[F.lit(x) for k, t in VALUE_TYPES.items() for x in (k, type_name(t))])
    known = F.try_element_at(names, value_type)
    unknown = F.raise_error(F.concat(F.lit("unsupported value type "), value_type)).cast("string")
    scalar = F.coalesce(known, unknown)
    return F.when(collection & (scalar == "string"), F.lit("array<string>")).otherwise(scalar)


def declarations(long: DataFrame) -> DataFrame:
    """Distinct names, types and flags of a batch, each with its first place in it.

    A small table, counted by hash: the batch is not sorted.
    """
    return long.groupBy("name", "type", *FLAG_DEFAULTS).agg(F.min("seq").alias("seq"))


def infer_fields(long: DataFrame, known: Sequence[FieldSpec] = (), markers: bool = False) -> DataFrame:
    """Fields of a batch: (field, type, retrievable, searchable, ..., suggestable).

    The first document that carries a field fixes its type and flags; fields in
    ``known`` stay as they are.  ``markers`` adds the marker field of each
    suggestable one.
    """
    taken = [s.name for s in known]
    named = declarations(long).withColumn("field", normalize_name_column(F.col("name")))
    if taken:
        named = named.filter(~F.col("field").isin(taken))
    declared = F.struct("seq", "name", "type", *FLAG_DEFAULTS)
    first = named.groupBy("field").agg(F.array_min(F.collect_list(declared)).alias("f"))
    stored = first.select("field", *[f"f.{c}" for c in ("type", *FLAG_DEFAULTS)]).withColumn(
        "stored", _storage_type(F.col("type"), F.col("collection"))
    )
    is_array = F.col("stored") == "array<string>"
    is_text = is_array | (F.col("stored") == "string")
    fields = stored.select(
        "field",
        F.col("stored").alias("type"),
        "retrievable",
        (F.col("searchable") & is_text).alias("searchable"),
        "filterable",
        (F.col("filterable") & ~F.col("stored").isin("geo", "variant")).alias("facetable"),
        (F.col("filterable") & ~is_array & (F.col("stored") != "variant")).alias("sortable"),
        "suggestable",
    )
    if markers:
        marked = F.array("field", F.concat("field", F.lit(SUGGEST_SUFFIX)))
        names = F.when(F.col("suggestable"), marked).otherwise(F.array("field"))
        fields = fields.withColumn("field", F.explode(names))
    return fields


def collect_specs(fields: DataFrame, known: Sequence[FieldSpec] = ()) -> list[FieldSpec]:
    """Field specs on the driver: one row per field, which the schema needs there anyway."""
    rows = fields.collect()
    reserved = sorted(r["field"] for r in rows if r["field"] and r["field"].startswith("__"))
    if reserved:
        raise FieldError(f"field names that begin with two underscores are reserved: {reserved}")
    found = [
        FieldSpec(r["field"], TYPE_NAMES[r["type"]], **{f: r[f] for f in FieldSpec.FLAGS}) for r in rows
    ]
    taken = {s.name for s in known}
    return [*known, *sorted((s for s in found if s.name not in taken), key=lambda s: s.name)]


def check_types(long: DataFrame, specs: Sequence[FieldSpec], on_mismatch: str = "report") -> DataFrame:
    """Fields whose type does not fit: (doc_id, field, doc_type, schema_type).

    A type fits itself, its collection, and an integer fits a double field.
    ``raise`` tests the batch's declarations and aborts it on a mismatch, of which it then looks for
    an example.
    """
    types = F.create_map(*[F.lit(x) for s in specs for x in (s.name, type_name(s.data_type))])
    field = normalize_name_column(F.col("name"))

    def mismatches(rows: DataFrame, *keep: str) -> DataFrame:
        checked = rows.select(
            *keep,
            field.alias("field"),
            _storage_type(F.col("type"), F.lit(False)).alias("doc_type"),
            F.try_element_at(types, field).alias("schema_type"),
        )
        doc, schema = F.col("doc_type"), F.col("schema_type")
        fits = (
            (doc == schema)
            | (F.concat(F.lit("array<"), doc, F.lit(">")) == schema)
            | (doc.isin("int", "bigint") & (schema == "double"))
        )
        return checked.filter(schema.isNotNull() & ~fits)

    if on_mismatch == "raise" and not mismatches(declarations(long)).isEmpty():
        first = mismatches(long, "doc_id").first()
        raise TypeMismatch(
            f"document {first.doc_id!r}: field {first.field!r} is {first.doc_type}, "
            f"the schema says {first.schema_type}"
        )
    return mismatches(long, "doc_id")


def _typed(text: Column, data_type: T.DataType) -> Column:
    if type_name(data_type) == "geo":
        return parse_point(text)
    if isinstance(data_type, T.VariantType):
        return F.try_parse_json(text)
    return text.cast(data_type)


def assemble(
    long: DataFrame, specs: Sequence[FieldSpec], present: str | None = None, keep_arrays: bool = False
) -> DataFrame:
    """Wide table: one row per document, one typed column per field, plus ``__seq``.

    A scalar field takes its first value, a collection all of them
    (``keep_arrays`` keeps every value of non-text fields declared as
    collections too).  ``present`` names a column listing the fields supplied.
    One aggregation by document gathers its fields once, into a map from which every
    column takes its own; fields that collide are looked up only where some do.
    """
    named = long.withColumn("field", normalize_name_column(F.col("name")))
    entry = F.struct("field", "name", "values")
    gathered = named.groupBy(F.col("doc_id").alias(KEY), F.col("seq").alias(SEQ)).agg(
        F.array_sort(F.collect_list(entry)).alias("__fields")
    )
    entries = F.col("__fields")
    first_of_name = lambda e, i: (i == 0) | ~e["field"].eqNullSafe(F.get(entries, i - 1)["field"])
    firsts = F.filter(entries, lambda e, i: first_of_name(e, i) & e["field"].isNotNull())
    by_name = F.map_from_entries(F.transform(firsts, lambda e: F.struct(e["field"], e["values"])))
    gathered = gathered.withColumns({"__by_name": by_name, "__collide": F.size(firsts) < F.size(entries)})

    def values_of(name: str, every: bool) -> Column:
        values = F.try_element_at(F.col("__by_name"), F.lit(name))
        if not every:
            return values
        parts = F.transform(F.filter(entries, lambda e: e["field"] == name), lambda e: e["values"])
        return F.when(F.col("__collide"), F.flatten(parts)).otherwise(values)

    columns = []
    for spec in (s for s in specs if not s.is_key):
        if spec.is_collection:
            values = values_of(spec.name, every=True)
            value = F.when(F.size(values) > 0, values)
        elif keep_arrays and not spec.is_text:
            value = F.transform(values_of(spec.name, every=False), lambda v, t=spec.data_type: _typed(v, t))
        else:
            value = _typed(F.try_element_at(values_of(spec.name, every=False), F.lit(1)), spec.data_type)
        columns.append(value.alias(spec.name, metadata=spec.to_struct_field().metadata))
    if present:
        columns.append(F.map_keys("__by_name").alias(present))
    return gathered.select(KEY, SEQ, *columns)


def key_spec() -> FieldSpec:
    return FieldSpec(KEY, T.StringType(), searchable=False)

