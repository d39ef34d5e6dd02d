"""Open documents from JSON lines, and fields inside of complex values.

A document whose fields nobody declared beforehand is a JSON object, one per line. Its fields become
rows of the long form by a lateral explode; their types come from one aggregation over the batch, so
no schema passes through the driver before it is known. Nested values stay whole as variants, and
paths into them are columns like others: filters, sorts and facets take them by name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import TYPE_NAMES, VALUE_TYPES, FieldError, normalize_name_column
from ..sizing import broadcast_if_small, staged
from .documents import FLAG_DEFAULTS

DOC = "__doc"


def _quoted(key: Column) -> Column:
    """Step of a path to a key; a key with both kinds of quotes cannot be named and gives null."""
    plain = F.when(~F.contains(key, F.lit("'")), F.concat(F.lit("['"), key, F.lit("']")))
    return plain.when(~F.contains(key, F.lit('"')), F.concat(F.lit('["'), key, F.lit('"]')))


def value_type(json_type: Column) -> Column:
    """Value type of a document field that holds a JSON type; nested and mixed values are variants."""
    return (
        F.when(json_type.isin("STRING", "ARRAY<STRING>", "ARRAY<VOID>"), "String")
        .when(json_type == "BIGINT", "Long")
        .when(json_type.startswith("DECIMAL") | (json_type == "DOUBLE"), "Double")
        .when(json_type == "BOOLEAN", "Boolean")
        .otherwise("Variant")
    )


def parsed_lines(lines: DataFrame, doc_id: str = "id", text: str = "value", seq: Column | None = None) -> DataFrame:
    """``doc_id, seq, line, __doc, reason`` of each line that is not blank.

    ``reason`` is null for a document: a JSON object (``__doc``) with a text, number or boolean under
    ``doc_id``. Without ``seq``, lines count in the order in which they are read.
    """
    if "'" in doc_id:
        raise FieldError(f"an id field cannot be called {doc_id!r}")
    numbered = lines.select(
        (F.monotonically_increasing_id() if seq is None else seq).cast("long").alias("seq"), F.col(text).cast("string").alias("line")
    )
    # A line is made and parsed once.  As output of a generator it stays so; the optimizer would copy plain
    # columns into every condition on them, down to the scan.
    parsed = F.struct("line", F.try_parse_json("line").alias(DOC))
    rows = numbered.select("seq", F.inline(F.array(parsed))).filter(F.trim("line") != "")
    value = F.try_variant_get(DOC, f"$['{doc_id}']", "variant")
    kind = F.schema_of_variant(value)
    is_object = F.ltrim("line").startswith("{") & F.col(DOC).isNotNull()
    scalar = value.isNotNull() & ~kind.rlike("^(OBJECT|ARRAY|VOID)")
    reason = F.when(F.col(DOC).isNull(), "no JSON").when(~is_object, "no object").when(~F.coalesce(scalar, F.lit(False)), "no id")
    return rows.select(F.try_variant_get(DOC, f"$['{doc_id}']", "string").alias("doc_id"), "seq", "line", DOC, reason.alias("reason"))


def rejected_lines(lines: DataFrame, doc_id: str = "id", text: str = "value", seq: Column | None = None) -> DataFrame:
    """``seq, line, reason`` of the lines that ``json_documents`` leaves out."""
    return parsed_lines(lines, doc_id, text, seq).filter(F.col("reason").isNotNull()).select("seq", "line", "reason")


def _exploded(lines: DataFrame, doc_id: str, text: str, seq: Column | None) -> DataFrame:
    """(doc_id, seq, name, value) of each field that is not null; no shuffle."""
    rows = parsed_lines(lines, doc_id, text, seq).filter(F.col("reason").isNull()).select("doc_id", "seq", DOC)
    fields = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(DOC).outer()))
    named = fields.select("doc_id", "seq", F.col("key").alias("name"), "value")
    return named.filter((F.col("name") != doc_id) & (F.col("name") != "") & ~F.is_variant_null("value"))


def json_fields(lines: DataFrame, doc_id: str = "id", text: str = "value") -> DataFrame:
    """``name, json_type, type, collection, documents``: the fields of a batch of JSON lines.

    ``json_type`` is the type that holds all of the field's values, so a field that is a whole number
    in one document and a fraction in another is a ``Double``, and one that is a text and a number a
    ``Variant``. Names that are one after normalisation share their type. Combined before the only
    shuffle; the result is as long as there are names.
    """
    fields = _exploded(lines, doc_id, text, None).withColumn("field", normalize_name_column(F.col("name")))
    merged = fields.groupBy("field").agg(
        F.schema_of_variant_agg("value").alias("json_type"),
        F.collect_set("name").alias("names"),
        F.count(F.lit(1)).alias("documents"),
    )
    return merged.select(
        F.explode("names").alias("name"),
        "json_type",
        value_type(F.col("json_type")).alias("type"),
        F.col("json_type").isin("ARRAY<STRING>", "ARRAY<VOID>").alias("collection"),
        "documents",
    )


def json_documents(
    lines: DataFrame,
    doc_id: str = "id",
    text: str = "value",
    seq: Column | None = None,
    fields: DataFrame | None = None,
    types: Mapping[str, str] | None = None,
    searchable: Sequence[str] = (),
    suggestable: Sequence[str] = (),
) -> DataFrame:
    """Long form of JSON lines, one object each, with fields that nobody declared.

    ``fields`` is a kept result of ``json_fields``; without it, the batch is read once more for the
    types. ``types`` gives some fields another value type (``{"when": "DateTime"}``). Arrays of texts
    are collections, other arrays, objects and values of mixed types are variants, whole. A JSON null
    is a field that the document does not have. Lines that are no JSON object with an id are left out
    (see ``rejected_lines``); an object that repeats a key is no JSON. A document's id is no field.
    """
    unknown = sorted(set((types or {}).values()) - set(VALUE_TYPES))
    if unknown:
        raise FieldError(f"unsupported value types {unknown}")
    # The types come from a pass over all lines, which is made once.
    known = (staged(json_fields(lines, doc_id, text), "json-fields") if fields is None else fields).select("name", "type", "collection")
    rows = _exploded(lines, doc_id, text, seq).join(broadcast_if_small(known), "name")
    kind = F.col("type")
    for name, given in (types or {}).items():
        kind = F.when(F.col("name") == name, given).otherwise(kind)
    rows = rows.withColumn("type", kind)
    texts = F.array_compact(F.try_variant_get("value", "$", "array<string>"))
    values = (
        F.when(F.col("collection"), texts)
        .when(F.col("type") == "Variant", F.array(F.to_json("value")))
        .otherwise(F.array(F.try_variant_get("value", "$", "string")))
    )
    given = {"searchable": F.col("name").isin(list(searchable)), "suggestable": F.col("name").isin(list(suggestable))}
    flags = [given.get(f, F.lit(d)).alias(f) for f, d in FLAG_DEFAULTS.items() if f != "collection"]
    return rows.select("doc_id", "seq", "name", "type", values.alias("values"), *flags, "collection")


@dataclass(frozen=True)
class Path:
    """A field inside of a complex one: ``path`` as in ``$.a.b[0]``, read as ``type`` (a type name such as
    ``bigint``) under ``name``."""

    name: str
    column: str
    path: str
    type: str = "string"


def _variant(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.VariantType, T.StringType)):
        raise FieldError(f"field {name!r} has no paths: it is {kind.simpleString()}")
    value = F.col(f"`{name}`")
    return F.try_parse_json(value) if isinstance(kind, T.StringType) else value


def with_paths(df: DataFrame, paths: Sequence[Path]) -> DataFrame:
    """The table with a typed column for each path into a variant (or a JSON text).

    A value that is missing or does not fit the type is null. Filters, sorts and facets use the columns
    like any others; from Parquet, only the paths in use are taken out of the variant.
    """
    taken = set(df.columns)
    for p in paths:
        if p.name in taken:
            raise FieldError(f"there is a field {p.name!r} already")
        if p.type not in TYPE_NAMES or p.type == "geo":
            raise FieldError(f"a path cannot be read as {p.type!r}")
        taken.add(p.name)
    return df.withColumns({p.name: F.try_variant_get(_variant(df, p.column), p.path, p.type) for p in paths})


def variant_paths(df: DataFrame, column: str, depth: int = 4) -> DataFrame:
    """``path, json_type, type, rows``: the leaves of a complex column, down to ``depth`` keys.

    A leaf is a scalar or an array, or an object at the last level. ``type`` is what ``Path`` takes; an
    array of other things than texts has none. One pass and one aggregation, as long as there are paths.
    """
    level = df.select(F.lit("$").alias("path"), _variant(df, column).alias("v")).filter(F.col("v").isNotNull())
    leaves = None
    for step in range(depth):
        # Arrays are leaves, and an array's elements have no key.
        inner = level.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()))
        inner = inner.filter(F.col("key").isNotNull() & ~F.is_variant_null("value"))
        inner = inner.select(F.concat("path", _quoted(F.col("key"))).alias("path"), F.col("value").alias("v"))
        inner = inner.withColumn("nested", F.to_json("v").startswith("{")).filter(F.col("path").isNotNull())
        ends = inner if step == depth - 1 else inner.filter("not nested")
        leaves = ends.drop("nested") if leaves is None else leaves.unionByName(ends.drop("nested"))
        level = inner.filter("nested").drop("nested")
    found = leaves.groupBy("path").agg(F.schema_of_variant_agg("v").alias("json_type"), F.count(F.lit(1)).alias("rows"))
    json_type = F.col("json_type")
    as_type = (
        F.when(json_type.isin("ARRAY<STRING>", "ARRAY<VOID>"), "array<string>")
        .when(json_type == "BIGINT", "bigint")
        .when(json_type.startswith("DECIMAL") | (json_type == "DOUBLE"), "double")
        .when(json_type == "BOOLEAN", "boolean")
        .when(json_type.isin("STRING", "VARIANT"), "string")
    )
    return found.select("path", "json_type", as_type.alias("type"), "rows")
