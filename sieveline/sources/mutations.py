"""Changes to a document table as DataFrame expressions.

The stored table may be far larger than a batch.  Each change therefore measures
the batch once; a small batch is broadcast, so the stored table is only scanned,
never shuffled.  A larger batch goes through one shuffle join by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import KEY, FieldError, FieldSpec, to_schema
from ..sizing import BROADCAST_LIMIT_BYTES, broadcast_if_small, is_small


def latest(batch: DataFrame, key: str = KEY, order: str = "seq") -> DataFrame:
    """Last row per key by the ``order`` column, which is dropped.  Combined on the map side."""
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in batch.columns]), F.struct(F.col(order)))
    chosen = batch.groupBy(F.col(key).alias("__key")).agg(last.alias("row")).select("row.*")
    return _with_metadata_of(chosen, batch.schema).drop(order)


def _with_metadata_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    known = {f.name: f.metadata for f in schema.fields if f.metadata}
    for name in df.columns:
        if known.get(name):
            df = df.withMetadata(name, known[name])
    return df


def evolve(base: DataFrame, specs: Sequence[FieldSpec]) -> DataFrame:
    """``base`` widened by the fields of ``specs`` it lacks; old rows read null."""
    have = set(base.columns)
    fields = [f for f in to_schema(specs).fields if f.name not in have]
    added = [F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in fields]
    return base.select("*", *added)


def _aligned(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the order and types of ``schema``; columns ``rows`` lacks are null."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType)
            .alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )


def upsert(
    base: DataFrame, batch: DataFrame, key: str = KEY, order: str = "seq", limit: int | None = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Insert new documents, replace stored ones as a whole; new columns widen the table."""
    batch = batch.filter(F.col(key).isNotNull())
    replacing = latest(batch, key, order)
    keys = broadcast_if_small(batch.select(key).distinct(), limit)
    kept = base.join(keys, key, "left_anti")
    return kept.unionByName(replacing, allowMissingColumns=True)


def _merge_batch(batch: DataFrame, key: str, order: str, present: str) -> DataFrame:
    """One row per key: the last supplied value per column, and all supplied columns."""
    last = [
        F.max_by(
            F.when(F.array_contains(present, c), F.struct(F.col(f"`{c}`"))),
            F.when(F.array_contains(present, c), F.struct(F.col(order))),
        ).alias(c)
        for c in batch.columns
        if c not in (key, order, present)
    ]
    # A struct around each value tells "set to null" from "not supplied".
    return batch.groupBy(key).agg(*last)


def merge_update(
    base: DataFrame,
    batch: DataFrame,
    key: str = KEY,
    order: str = "seq",
    present: str = "present",
    limit: int | None = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Overwrite the supplied fields, keep the others, insert unknown keys.

    ``present`` is an array column naming the fields a row supplies.  Fields the
    table does not have raise: a partial update never widens it.
    """
    extra = sorted(set(batch.columns) - set(base.columns) - {order, present})
    if extra:
        raise FieldError(f"partial update with unknown fields {extra}")
    batch = batch.filter(F.col(key).isNotNull())
    changes = _merge_batch(batch, key, order, present)
    changed = [c for c in changes.columns if c != key]

    def merged(name: str) -> Column:
        metadata = base.schema[name].metadata
        if name == key:
            return F.col(f"`{key}`")
        if name not in changed:
            return F.col(f"b.`{name}`").alias(name, metadata=metadata)
        supplied = F.col(f"c.`{name}`")
        value = F.when(supplied.isNotNull(), supplied[name]).otherwise(F.col(f"b.`{name}`"))
        return value.cast(base.schema[name].dataType).alias(name, metadata=metadata)

    columns = [merged(c) for c in base.columns]
    if not is_small(batch, limit):
        return base.alias("b").join(changes.alias("c"), key, "full_outer").select(*columns)
    # The stored table is scanned twice, once for its key only, and not shuffled.
    updated = base.alias("b").join(F.broadcast(changes.alias("c")), key, "left").select(*columns)
    stored_keys = base.select(key).join(F.broadcast(changes.select(key)), key, "left_semi")
    new = changes.join(F.broadcast(stored_keys), key, "left_anti")
    new = new.select(key, *[F.col(f"`{c}`")[c].alias(c) for c in changed])
    return updated.unionByName(_aligned(new, base.schema))


def remove(base: DataFrame, keys: DataFrame, key: str = KEY, limit: int | None = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Rows of ``base`` whose key is not among ``keys``."""
    return base.join(broadcast_if_small(keys.select(key).distinct(), limit), key, "left_anti")


# What a change does to a key that is stored, and to one that is not.
_ACTIONS = {
    "upsert": ("replaced", "inserted"),
    "merge": ("merged", "inserted"),
    "remove": ("removed", "absent"),
}


def mutation_report(
    base: DataFrame, batch: DataFrame, kind: str, key: str = KEY, limit: int | None = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Outcome per input key: (id, succeeded, error_message, action).  A null key fails."""
    stored_action, new_action = _ACTIONS[kind]
    keys = batch.select(key).distinct()
    if is_small(keys, limit):
        stored = F.broadcast(base.select(key).join(F.broadcast(keys), key, "left_semi"))
    else:
        stored = base.select(key)
    joined = keys.join(stored.withColumn("stored", F.lit(True)), key, "left")
    valid = F.col(key).isNotNull()
    return joined.select(
        F.col(key).alias("id"),
        valid.alias("succeeded"),
        F.when(~valid, F.lit("document without a key")).alias("error_message"),
        F.when(valid & F.col("stored"), stored_action).when(valid, new_action).alias("action"),
    )
