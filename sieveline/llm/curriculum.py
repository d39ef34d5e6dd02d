"""Mixing sources to target weights: a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1, linear between its points. The
integral of the schedule is the source's weight in the whole mix and sets its target. Read
along time, the integral is also the source's cumulative demand: the document that covers a
word of that demand is trained on at the time at which the demand reaches it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.llm.common import text_key, word_count
from sieveline.operators.ranking import hex_digits, ranked, running_total
from sieveline.sizing import broadcast_if_small, staged

MAX_REPEATS = 3


def source_key(source: str) -> Column:
    """A source as a text that is never null and sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1"))


def alternating_schedule(sources: DataFrame) -> DataFrame:
    """(source key, t, weight) for keys in order: integrals 1, 2, 3, repeating; every other source
    falls from 3/2 of its weight to 1/2, the others rise."""
    order = ranked(sources.select("__source").distinct(), [F.col("__source")], "i")
    weight = (F.col("i") % 3 + 1).cast("double")
    first = F.when(F.col("i") % 2 == 0, 1.5).otherwise(0.5)
    points = F.array(
        F.struct(F.lit(0.0).alias("t"), (weight * first).alias("weight")),
        F.struct(F.lit(1.0).alias("t"), (weight * (2.0 - first)).alias("weight")),
    )
    return order.select("__source", F.explode(points).alias("p")).select("__source", "p.t", "p.weight")


def integrated(schedule: DataFrame) -> DataFrame:
    """One row per source: its ``weight`` (the integral) and ``knots``, linear pieces with the
    demand before each. A source without points that span some time has weight 0."""
    points = schedule.groupBy("__source").agg(F.sort_array(F.collect_set(F.struct("t", "weight"))).alias("p"))
    pieces = F.expr(
        "transform(slice(p, 1, size(p) - 1), (a, i) -> struct(a.t as t, a.weight as w, p[i + 1].t - a.t as dt, "
        "p[i + 1].weight - a.weight as dw, (a.weight + p[i + 1].weight) / 2 * (p[i + 1].t - a.t) as area))"
    )
    knots = F.expr(
        "transform(pieces, (x, i) -> struct(aggregate(slice(pieces, 1, i), 0D, (s, y) -> s + y.area) as before, "
        "x.t as t, x.w as w, x.dt as dt, x.dw as dw))"
    )
    weight = F.expr("aggregate(pieces, 0D, (s, y) -> s + y.area)")
    return points.withColumn("pieces", pieces).select("__source", weight.alias("weight"), knots.alias("knots"))


def targets(sources: DataFrame, repeats: int) -> DataFrame:
    """Adds ``target``: shares of all words by weight, none above ``repeats`` times its source.

    The excess of a capped source goes to the others by weight. Each round knows more capped
    sources and raises the level; it stops when no source is newly capped. Two sums come to the
    driver in each round, whatever the number of sources.
    """
    cap = F.col("source_size") * repeats
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = cap < F.lit(level) * F.col("weight")
        found = sources.agg(
            F.count_if(full), F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if found[0] == capped or not found[2]:
            break
        capped, level = found[0], (total - found[1]) / found[2]
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def time_of(demand: Column, knots: str) -> Column:
    """Time at which the integral of the schedule in ``knots`` reaches ``demand``."""
    piece = F.element_at(F.filter(knots, lambda k: k["before"] <= demand), -1)
    rest = demand - piece["before"]
    slope = piece["dw"] / piece["dt"]
    root = F.sqrt(F.greatest(piece["w"] * piece["w"] + slope * rest * 2.0, F.lit(0.0)))
    # Root of w x + slope x^2 / 2 = rest in the form that also holds for slope 0.
    step = F.when(rest == 0, 0.0).otherwise(rest * 2.0 / (piece["w"] + root))
    return F.least(piece["t"] + step, F.lit(1.0))


def mix_sources(
    docs: DataFrame,
    schedule: DataFrame | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken, positions``.

    ``schedule`` has rows (source, t, weight); without one, :func:`alternating_schedule`. A
    source takes whole documents in a fixed shuffled order until its target is met as nearly as
    a document allows: all of them ``target // source_size`` times, the first ones once more.
    ``positions`` has the training time of each copy: of the demand that its middle covers.

    Sizes are words; null and empty texts have none and are never taken beyond 0 words. A null
    source is a source of its own, the last. Sources missing in ``schedule`` weigh 0. Ties
    in the shuffled order (rows that repeat a ``doc_id``) are taken in the order of their sizes.
    Columns of ``docs`` with a name of the result are replaced. An empty table gives no rows.
    Reruns agree: the order depends on ``doc_id`` alone.
    """
    added = ["size", "source_size", "target", "copies", "taken", "positions"]
    rows = docs.withColumns({"__source": source_key(source), "__size": word_count(text), "__key": text_key(doc_id)})
    rows = rows.drop(*[c for c in added if c in docs.columns and c not in (doc_id, source, text)])
    sizes = staged(rows.groupBy("__source").agg(F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("n")), "mix-sizes")
    if schedule is None:
        points = alternating_schedule(sizes)
    else:
        points = schedule.select(source_key(source).alias("__source"), F.col("t").cast("double"), F.col("weight").cast("double"))
    sources = sizes.join(integrated(points), "__source", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    sources = staged(targets(sources, repeats).drop("n"), "mix-targets")
    digits = hex_digits(sizes.agg(F.sum("n")).first()[0] or 0)
    placed = running_total(rows, ["__source"], "__key", ["__size"], F.col("__size"), digits, "__before")
    sources = sources.withColumnsRenamed({"weight": "__weight", "knots": "__knots"})
    mixed = placed.join(broadcast_if_small(sources), "__source")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - full * F.col("source_size")
    more = (F.col("__before") + F.col("__size") / 2.0 <= rest) & (rest > 0)
    mixed = mixed.withColumn("copies", (full + more.cast("long")).cast("int"))
    middle = lambda j: (j * F.col("source_size") + F.col("__before") + F.col("__size") / 2.0) / F.col("target")
    at = lambda j: time_of(F.least(middle(j), F.lit(1.0)) * F.col("__weight"), "__knots")
    positions = F.when(
        (F.col("copies") > 0) & (F.col("target") > 0), F.transform(F.sequence(F.lit(0), F.col("copies") - 1), at)
    ).otherwise(F.array().cast("array<double>"))
    return mixed.withColumns(
        {"size": F.col("__size"), "taken": F.col("copies") * F.col("__size"), "positions": positions}
    ).drop("__source", "__size", "__key", "__before", "__weight", "__knots")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy with its ``position``, range-sorted by it; documents without copies go.

    Texts without words may share a position: ties are ordered by what the source took so far."""
    copies = mixed.drop("copy", "position").select("*", F.posexplode("positions").alias("copy", "position"))
    return copies.orderBy("position", "copy", "source_size", "size")
