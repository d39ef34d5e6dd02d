"""Sharding by a hierarchical weighted hash tree: regions, racks, shards."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.llm.common import text_key
from sieveline.operators.ranking import hex_digits, running_total

SHARDS_PER_RACK = 4
RACKS_PER_REGION = 2
BASE_SHARDS = 24


@dataclass(frozen=True)
class Shard:
    """A leaf. Shards of a later ``generation`` joined when the earlier ones were in use."""

    shard: int
    region: int
    rack: int
    weight: float = 1.0
    generation: int = 0


def shard_tree(shards: int, base: int = BASE_SHARDS) -> list[Shard]:
    """Tree of ``shards`` equal shards: the first ``base`` together, each further one by itself."""
    per_region = SHARDS_PER_RACK * RACKS_PER_REGION
    place = lambda s: (s // per_region, s % per_region // SHARDS_PER_RACK)
    return [Shard(s, *place(s), generation=max(0, s - base + 1)) for s in range(shards)]


def draw(key: Column, node: Column, weight: Column) -> Column:
    """Waiting time of a node: exponential with the node's weight, from a hash of key and node."""
    bits = F.shiftrightunsigned(F.xxhash64(key, node), 11).cast("double")
    return -F.log((bits + 0.5) / float(1 << 53)) / weight


def descend(key: Column, tree: Iterable[Shard]) -> Column:
    """struct(region, rack, shard) of a key.

    At every level the child with the shortest waiting time wins, which gives each child its
    share of the weight. A child's draw depends on the key, the child and the child's weight, so
    a changed weight moves keys only into or out of the subtrees on its path. Generations are
    separate at the top level: the nodes of a new one only take keys, and only for its own shards.
    """
    levels: dict[tuple, dict[tuple, float]] = {}
    for s in tree:
        path = ((s.generation, s.region), s.rack, s.shard)
        for depth in range(3):
            children = levels.setdefault(path[:depth], {})
            children[path[: depth + 1]] = children.get(path[: depth + 1], 0.0) + s.weight
    if any(w <= 0 for children in levels.values() for w in children.values()):
        raise ValueError("weights must be positive")

    def child(parent: tuple) -> Column:
        nodes = sorted(levels[parent].items())
        draws = [
            F.struct(draw(key, F.lit(repr(path)), F.lit(w)).alias("wait"), F.lit(i).alias("i"))
            for i, (path, w) in enumerate(nodes)
        ]
        won = F.array_min(F.array(*draws))["i"] if len(draws) > 1 else F.lit(0)
        if len(parent) == 2:
            return F.element_at(F.array(*[F.lit(path[2]) for path, _ in nodes]), won + 1)
        below = [child(path) for path, _ in nodes]
        if len(parent) == 0:
            below = [
                F.struct(F.lit(path[0][1]).alias("region"), b["rack"].alias("rack"), b["shard"].alias("shard"))
                for (path, _), b in zip(nodes, below)
            ]
        else:
            below = [F.struct(F.lit(path[1]).alias("rack"), b.alias("shard")) for (path, _), b in zip(nodes, below)]
        chosen = below[-1]
        for i in range(len(below) - 2, -1, -1):
            chosen = F.when(won == i, below[i]).otherwise(chosen)
        return chosen

    return child(())


def place(docs: DataFrame, tree: list[Shard], key: str = "doc_id") -> DataFrame:
    """``docs`` with ``region``, ``rack`` and ``shard``, by the value of ``key`` alone.

    No shuffle and no state: rows of one key always meet. A null key is a value of its own,
    different from every text. Columns of ``docs`` with a name of the result are replaced.
    """
    value = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))
    found = docs.withColumn("__leaf", descend(value, tree))
    return found.withColumns({c: F.col(f"__leaf.{c}") for c in ("region", "rack", "shard")}).drop("__leaf")


def with_slots(placed: DataFrame, key: str = "doc_id", order: list[str] | None = None) -> DataFrame:
    """``placed`` with ``slot``: a gapless number from 0 within each shard, in an order by hash of
    ``key``, then by ``order``; rows equal in these are interchangeable. A shard is numbered in
    buckets, so neither a heavy shard nor a small number of shards limits the tasks."""
    rows = placed.drop("slot").withColumn("__key", text_key(key))
    digits = hex_digits(placed.count())
    one = F.lit(1).cast("long")
    return running_total(rows, ["shard"], "__key", order or [key], one, digits, "slot").drop("__key")


def shard_documents(docs: DataFrame, shards: int = BASE_SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``size, text_crc32, law, region, rack, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 8, ``grown_shard`` the shard with one shard more. A
    null text has no bytes (size 8, checksum 0). Equal keys share a shard. An empty table gives no rows.
    """
    bytes_ = F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary"))
    sized = docs.withColumns(
        {
            "size": (F.octet_length(bytes_) + 8).cast("long"),
            "text_crc32": F.crc32(bytes_),
            "law": F.lit("key"),
        }
    )
    grown = place(sized.drop("grown_shard"), shard_tree(shards + 1), doc_id).withColumnRenamed("shard", "grown_shard")
    return with_slots(place(grown, shard_tree(shards), doc_id), doc_id, [doc_id, "size", "text_crc32"])
