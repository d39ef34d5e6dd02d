"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Words are runs of other characters than space and ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# A group is hot if it holds at least this share of all rows: there are at most as many hot groups.
HOT_SHARE = 1000
# Fewer narrow rows of one group are no load for a task of a shuffle join. Where all groups are smaller,
# as those of links mostly are, the driver has no table to build for a broadcast.
HOT_ROWS = 256


def word_count(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(column: str | Column) -> Column:
    """Hex digits spread evenly by a column's value as text; null is a value of its own."""
    value = F.col(column) if isinstance(column, str) else column
    return F.md5(F.coalesce(value.cast("string"), F.lit("null")))


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but the used ones under other names, and the columns that undo it.

    For operators whose results may be named like columns that must survive them.
    """
    names = {c: f"__doc_{i}" for i, c in enumerate(docs.columns) if c not in used}
    return docs.withColumnsRenamed(names), [F.col(names.get(c, c)).alias(c) for c in docs.columns]


def join_groups(rows: DataFrame, groups: DataFrame, key: str, members: str, total: int, least: int = 0) -> DataFrame:
    """Inner join of ``rows`` to one row per ``key`` of ``groups``, safe against hot keys.

    ``members`` counts a group's rows and ``total`` all rows. Groups of at least 1/1000 of all
    rows are at most 1000, so they are broadcast; the other groups are joined by a shuffle in
    which no key holds more than that share, or than ``least`` rows: smaller groups are never hot.
    """
    if total < least:
        return rows.join(groups.hint("merge"), key)
    is_hot = (F.col(members) * HOT_SHARE >= total) & (F.col(members) >= least)
    hot = F.broadcast(groups.filter(is_hot))
    rest = groups.filter(~is_hot)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rest, key))
