"""Positions and running totals in an order, without sorting all rows in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from sieveline.sizing import staged

ROWS_PER_BUCKET = 256


def hex_digits(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Leading digits of a hex key that cut ``rows`` rows into buckets of about ``per_bucket``."""
    return max(1, math.ceil(math.log(max(rows, 1) / per_bucket + 1, 16)))


def running_total(
    df: DataFrame, by: list[str], hex_key: str, order: list[str], amount: Column, digits: int, name: str
) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over the rows of a group before each row.

    Rows of a group (the columns ``by``) are ordered by ``hex_key``, an evenly spread hex
    string, then by ``order``. Its first ``digits`` digits cut every group into buckets, however
    large the group is: totals are taken per bucket, summed over buckets in two levels, and only
    a bucket is ever sorted. Rows equal in ``hex_key`` and ``order`` are interchangeable.
    """
    bucket, top = "__bucket", "__top"
    rows = df.withColumns({bucket: F.substring(hex_key, 1, digits), "__amount": amount})
    totals = rows.groupBy(*by, bucket).agg(F.sum("__amount").alias("__total"))
    totals = totals.withColumn(top, F.substring(bucket, 1, digits // 2))
    before = lambda *cols: Window.partitionBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    tops = totals.groupBy(*by, top).agg(F.sum("__total").alias("__total"))
    tops = tops.withColumn("__above", F.sum("__total").over(before(*by).orderBy(top))).drop("__total")
    # Null-safe: a group may be null.
    on = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in [*by, top]]
    within = F.sum("l.__total").over(before(*[f"l.{c}" for c in by], f"l.{top}").orderBy(f"l.{bucket}"))
    starts = (
        totals.alias("l")
        .join(tops.alias("r"), on)
        .select(
            *[F.col(f"l.`{c}`") for c in [*by, bucket]],
            (F.coalesce("r.__above", F.lit(0)) + F.coalesce(within, F.lit(0))).alias("__start"),
        )
    )
    on = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in [*by, bucket]]
    inside = before(*[f"l.{c}" for c in by], f"l.{bucket}").orderBy(*[f"l.{c}" for c in [hex_key, *order]])
    return (
        rows.alias("l")
        .join(starts.alias("r"), on)
        .select(
            *[F.col(f"l.`{c}`") for c in df.columns],
            (F.col("r.__start") + F.coalesce(F.sum("l.__amount").over(inside), F.lit(0))).alias(name),
        )
    )


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with ``name``: each row's position, from 0, in the order of ``order``.

    Rows are cut into ranges of the order and staged, so that every row stays in its range; a
    range's first position is the number of rows in the ranges before it. No task sorts more
    than its range.
    """
    rows = staged(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranked")
    counts = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    # One row per range: as many as there are shuffle partitions.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__range").orderBy(*order)
    position = F.col("__start") + F.row_number().over(inside) - 1
    return rows.join(F.broadcast(starts), "__range").withColumn(name, position).drop("__range", "__start")
