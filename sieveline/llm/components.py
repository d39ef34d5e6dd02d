"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sieveline.llm.common import HOT_ROWS, join_groups
from sieveline.sizing import staged


def forest(pairs: list[tuple]) -> list[tuple]:
    """(node, smallest node of its component) for the nodes of some links, in one task."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in list(parent) if root(x) != x]


def star(links: DataFrame, large: bool) -> DataFrame:
    """One step: every node's neighbours (larger ones, or smaller ones) are linked to the least of
    its neighbourhood. A node with very many links is no hot spot in the join."""
    if large:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("__least"), F.count(F.lit(1)).alias("__n"))
    least = least.withColumn("__least", F.least("a", "__least"))
    around = join_groups(around, least, "a", "__n", around.count(), HOT_ROWS)
    if large:
        moved = around.filter("b > a").select(F.col("b").alias("a"), F.col("__least").alias("b"))
    else:
        moved = around.select(F.col("b").alias("a"), F.col("__least").alias("b")).unionByName(
            around.select("a", F.col("__least").alias("b"))
        )
    return moved.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): the smallest node it can reach.

    Nodes without links have no row. Links are joined in rounds, each staged, until a round changes nothing.
    Links may repeat and may run either way; a link of a node to itself, or to null, is none.
    """
    edges = staged(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    sign = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = sign(edges)
    while before[0]:
        edges = staged(star(staged(star(edges, True), "links"), False), "links")
        after = sign(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
