"""Field names, field flags and type rules of a document table.

A document table is an ordinary DataFrame: one row per document, the string
column ``__id`` as key, one column per field.  What may be done with a field
(search, filter, facet, sort, return, suggest) is kept in the column's
``StructField.metadata``, which Parquet files carry along.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

KEY = "__id"
# Metadata entry of a key column that is the text of another column of the table.
KEY_OF = "key_of"

# Prefix of stored field names, suffix of suggestion marker fields.
STORED_PREFIX = "f_"
SUGGEST_SUFFIX = "__suggest"

GEO_TYPE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ]
)

# Value type of a document field -> Spark type of its column.
VALUE_TYPES: dict[str, T.DataType] = {
    "Char": T.StringType(),
    "String": T.StringType(),
    "Byte": T.IntegerType(),
    "Short": T.IntegerType(),
    "Integer": T.IntegerType(),
    "Long": T.LongType(),
    "Double": T.DoubleType(),
    "Decimal": T.DoubleType(),
    "ExactDecimal": T.DecimalType(38, 18),
    "Boolean": T.BooleanType(),
    "DateTime": T.TimestampType(),
    "GeoPoint": GEO_TYPE,
    "Complex": T.StringType(),
    "Variant": T.VariantType(),
}

# Name of each column type in a field-spec DataFrame.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "array<string>": T.ArrayType(T.StringType()),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "decimal(38,18)": T.DecimalType(38, 18),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "geo": GEO_TYPE,
    "variant": T.VariantType(),
}


def type_name(data_type: T.DataType) -> str:
    return "geo" if data_type == GEO_TYPE else data_type.simpleString()


class FieldError(ValueError):
    """A field is used in a way its flags or its type do not allow."""


_WORD_CATEGORIES = {"Mn", "Nd", "Pc"}


def _is_word_char(char: str) -> bool:
    category = unicodedata.category(char)
    return category.startswith("L") or category in _WORD_CATEGORIES


def normalize_name(name: str | None, prefix: str = "") -> str | None:
    """Lower-case ``name`` with every non-word character turned into ``_``."""
    if not name:
        return None
    return prefix + "".join(c if _is_word_char(c) else "_" for c in name).lower()


def external_name(stored: str) -> str:
    """Name under which a stored field is returned."""
    return stored.removeprefix(STORED_PREFIX)


def normalize_name_column(name: Column) -> Column:
    """``normalize_name`` for a column of names (long-form rows)."""
    cleaned = F.lower(F.regexp_replace(name, r"[^\p{L}\p{Mn}\p{Nd}\p{Pc}]", "_"))
    return F.when(name != "", cleaned)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its normalised name; metadata is kept."""
    names = [normalize_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise FieldError(f"columns collide after normalisation: {clashes}")
    return df.toDF(*names)


@dataclass(frozen=True)
class FieldSpec:
    """Name, type and flags of one field."""

    name: str
    data_type: T.DataType
    retrievable: bool = True
    searchable: bool = False
    filterable: bool = True
    facetable: bool = True
    sortable: bool = True
    suggestable: bool = False

    FLAGS = ("retrievable", "searchable", "filterable", "facetable", "sortable", "suggestable")

    @property
    def is_key(self) -> bool:
        return self.name == KEY

    @property
    def is_collection(self) -> bool:
        return isinstance(self.data_type, T.ArrayType)

    @property
    def is_text(self) -> bool:
        element = self.data_type.elementType if self.is_collection else self.data_type
        return isinstance(element, T.StringType)

    def to_struct_field(self) -> T.StructField:
        flags = {flag: getattr(self, flag) for flag in self.FLAGS}
        return T.StructField(self.name, self.data_type, True, {"flags": flags})

    @classmethod
    def from_struct_field(cls, field: T.StructField) -> FieldSpec:
        """Flags from the metadata; a plain column may be used in every way its type allows."""
        spec = cls(field.name, field.dataType)
        is_point = isinstance(field.dataType, T.StructType)
        is_variant = isinstance(field.dataType, T.VariantType)
        spec = replace(
            spec,
            searchable=spec.is_text and not spec.is_key,
            facetable=not (is_point or is_variant),
            sortable=not (spec.is_collection or is_variant),
        )
        return replace(spec, **field.metadata.get("flags", {}))


def specs_of(schema: T.StructType) -> list[FieldSpec]:
    return [FieldSpec.from_struct_field(f) for f in schema.fields]


def to_schema(specs: Iterable[FieldSpec]) -> T.StructType:
    """Schema with the key first and the other fields sorted by name."""
    ordered = sorted(specs, key=lambda s: (not s.is_key, s.name))
    return T.StructType([s.to_struct_field() for s in ordered])


def with_flags(df: DataFrame, name: str, **flags: bool) -> DataFrame:
    """Set flags of one column of ``df``."""
    spec = replace(FieldSpec.from_struct_field(df.schema[name]), **flags)
    return df.withMetadata(name, spec.to_struct_field().metadata)


def resolve(schema: T.StructType, raw_name: str | None) -> FieldSpec | None:
    """Field of ``schema`` meant by ``raw_name``, or ``None`` for an unknown name."""
    wanted = normalize_name(raw_name)
    if wanted is None:
        return None
    for field in schema.fields:
        if normalize_name(field.name) == wanted:
            return FieldSpec.from_struct_field(field)
    return None


def require(spec: FieldSpec, flag: str) -> FieldSpec:
    if not getattr(spec, flag):
        raise FieldError(f"field {spec.name!r} is not {flag}")
    return spec


def column(spec: FieldSpec) -> Column:
    return F.col(f"`{spec.name}`")
