"""Line dedup: repeated runs of lines by prefix doubling over line-id sequences.

Every text is a sequence of line ids. Suffixes are sorted by their first 1, 2, 4, ... lines: a
position's rank for 2k lines is the rank of the pair of its ranks for k lines here and k lines
on. The suffixes that agree in their first m lines are one interval of the suffix array whose
longest common prefix is at least m; two ranks of overlapping blocks name it. A run must have
``min_words`` words and every line has one, so m never exceeds ``min_words``: doubling stops there,
and no suffix is sorted deeper than the intervals ask for.

Positions whose lines occur once take no part, nor do, in each round, those whose block does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.llm.common import join_groups, word_count
from sieveline.operators.ranking import ranked
from sieveline.sizing import broadcast_if_small, staged

MIN_WORDS = 50
# A document's place in the order of all documents, and a line's place in its document.
LINE_BITS = 28


def text_lines(rows: DataFrame) -> DataFrame:
    """Lines with words: ``__id, __text_hash, seq`` (their number), ``idx`` (among all lines), hash, words."""
    lines = F.transform(
        F.split("__text", "\n"),
        lambda x, i: F.struct(
            i.alias("idx"), F.xxhash64(x).alias("h1"), F.xxhash64(F.lit("line"), x).alias("h2"), word_count(x).cast("int").alias("w")
        ),
    )
    some = F.filter(lines, lambda x: x["w"] > 0)
    found = rows.select("__id", "__text_hash", F.posexplode(some).alias("seq", "line"))
    return found.select("__id", "__text_hash", "seq", "line.idx", F.struct("line.h1", "line.h2").alias("line"), "line.w")


def renamed(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``rows`` whose ``key`` occurs more than once, with its ``rank`` among the repeated keys."""
    names = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    names = ranked(names, order, "rank")
    return join_groups(rows, names, key, "__n", rows.count())


def doubled(level: DataFrame, step: int) -> DataFrame:
    """Ranks for ``2 * step`` lines from the ranks for ``step`` lines (``ord, seq, rank``)."""
    ahead = Window.partitionBy("ord").orderBy("seq").rangeBetween(step, step)
    pairs = level.withColumn("ahead", F.max("rank").over(ahead)).filter("ahead is not null")
    pairs = pairs.select("ord", "seq", F.struct("rank", "ahead").alias("pair"))
    return renamed(pairs, "pair", [F.col("pair")]).select("ord", "seq", "rank")


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Shortest runs of ``min_words`` words that start, or that end, at each line.

    ``ord, start, m`` (lines) and the first and last line's ``idx``. Every repeated run with
    enough words is the union of such runs inside it.
    """
    before = Window.partitionBy("ord").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    at = lines.withColumn("c", F.coalesce(F.sum("w").over(before), F.lit(0)).cast("long"))
    at = at.withColumn("e", F.col("c") + F.col("w"))
    on = Window.partitionBy("ord").orderBy("c").rangeBetween(0, min_words - 1)
    back = Window.partitionBy("ord").orderBy("e").rangeBetween(-(min_words - 1), 0)
    starting = at.select(
        "ord",
        F.col("seq").alias("start"),
        F.max("seq").over(on).alias("end"),
        F.col("idx").alias("first"),
        F.max("idx").over(on).alias("last"),
        (F.max("e").over(on) - F.col("c")).alias("words"),
        F.count(F.lit(1)).over(on).alias("m"),
    )
    ending = at.select(
        "ord",
        F.min("seq").over(back).alias("start"),
        F.col("seq").alias("end"),
        F.min("idx").over(back).alias("first"),
        F.col("idx").alias("last"),
        (F.col("e") - F.min("c").over(back)).alias("words"),
        F.count(F.lit(1)).over(back).alias("m"),
    )
    whole = (F.col("end") - F.col("start") + 1 == F.col("m")) & (F.col("words") >= min_words)
    return starting.unionByName(ending).filter(whole).select("ord", "start", "m", "first", "last").distinct()


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(__id, __text_hash, __runs, __removed): the line ranges of each document that repeat earlier lines."""
    lines = staged(text_lines(docs), "lines")
    ids = lines.filter("seq = 0").select("__id", "__text_hash").distinct()
    ids = staged(ranked(ids, [F.col("__id"), F.col("__text_hash")], "ord"), "line-documents")
    repeated = renamed(lines.dropDuplicates(["__id", "__text_hash", "seq"]), "line", [F.col("line")]).alias("l")
    same = F.col("l.__id").eqNullSafe(F.col("r.__id")) & (F.col("l.__text_hash") == F.col("r.__text_hash"))
    base = staged(repeated.join(ids.alias("r"), same).select("ord", "seq", "idx", "w", "rank"), "lines-0")
    levels = [base.select("ord", "seq", "rank")]
    while 2 ** len(levels) <= min_words:
        step = 2 ** (len(levels) - 1)
        levels.append(staged(doubled(levels[-1], step), f"lines-{2 * step}"))
    ranks = None
    for k, level in enumerate(levels):
        level = level.withColumn("k", F.lit(k))
        ranks = level if ranks is None else ranks.unionByName(level)

    found = windows(base, min_words)
    k = F.floor(F.log2("m")).cast("int")
    found = found.withColumn("k", k)
    found = found.withColumn("tail", F.expr("cast(start + m - shiftleft(1, k) as int)"))
    at = lambda place, name: ranks.select("ord", F.col("seq").alias(place), "k", F.col("rank").alias(name))
    found = found.join(at("start", "head_rank"), ["ord", "start", "k"]).join(at("tail", "tail_rank"), ["ord", "tail", "k"])
    place = F.shiftleft("ord", LINE_BITS) + F.col("start")
    found = found.select(
        "ord", "start", "m", "first", "last", F.struct("m", "head_rank", "tail_rank").alias("interval"), place.alias("place")
    )
    found = staged(found, "line-intervals")
    leaders = found.groupBy("interval").agg(F.min("place").alias("leader"), F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    copies = join_groups(found, leaders, "interval", "__n", found.count()).filter("place > leader")

    # Overlapping and touching runs of a document become one; lines without words between them go too.
    earlier = Window.partitionBy("ord").orderBy("start", "m")
    reach = F.max(F.col("start") + F.col("m")).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    ranges = copies.select("ord", "start", "m", "first", "last").distinct()
    ranges = ranges.withColumn("new", (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("int"))
    ranges = ranges.withColumn("run", F.sum("new").over(earlier.rowsBetween(Window.unboundedPreceding, 0)))
    ranges = ranges.groupBy("ord", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    runs = ranges.groupBy("ord").agg(
        F.array_sort(F.collect_list(F.struct("first", "last"))).alias("__runs"), F.sum(F.expr("last - first + 1")).alias("__removed")
    )
    return runs.join(ids, "ord").select("__id", "__text_hash", "__runs", "__removed")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the later copies of repeated runs of lines; adds ``removed_lines, removed_runs``.

    A run is a sequence of neighbouring lines with at least ``min_words`` words together. Of equal
    runs, the first by document id, then by line, stays. Lines are equal when identical; lines
    without words do not interrupt a run; they go if the lines next to them do, and stay elsewhere. A text
    whose lines all go is empty. Null texts stay null; documents with a null id come first. Rows
    that repeat an id with the same text are one document and are treated alike; with different
    texts they come in the order of a hash. Columns of ``docs`` with a name of the result are
    replaced. An empty table gives no rows.
    """
    value = F.col(text).cast("string")
    key = {"__id": F.col(doc_id), "__text_hash": F.xxhash64(value)}
    rows = docs.select(F.col(doc_id).alias("__id"), F.xxhash64(value).alias("__text_hash"), value.alias("__text"))
    runs = staged(repeated_runs(rows, min_words), "line-runs")
    left, right = docs.withColumns(key).alias("l"), broadcast_if_small(runs).alias("r")
    same = F.col("l.__id").eqNullSafe(F.col("r.__id")) & (F.col("l.__text_hash") == F.col("r.__text_hash"))
    kept = F.filter(
        F.split(F.col(text), "\n"), lambda _, i: ~F.exists("__runs", lambda r: (i >= r["first"]) & (i <= r["last"]))
    )
    cleaned = F.when(F.col("__runs").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    found = left.join(right, same, "left").select(*[F.col(f"l.`{c}`") for c in docs.columns], "r.__runs", "r.__removed")
    return found.withColumns(
        {
            text: cleaned,
            "removed_lines": F.coalesce("__removed", F.lit(0)).cast("long"),
            "removed_runs": F.coalesce(F.size("__runs"), F.lit(0)).cast("long"),
        }
    ).drop("__runs", "__removed")
