"""Facets from bitmaps against facets that read the documents."""

import pytest
from pyspark.sql import functions as F

from sieveline import And, FieldError, Term, TermFacet, facets
from sieveline.operators.bitmaps import BitmapFacet, bitmap_facets, facet_bitmaps, merge_bitmaps, numbered, selected_total

FIELDS = ["color", "size", "weight", "new", "Tags"]


@pytest.fixture(scope="module")
def rows(spark):
    """More rows than two blocks; a color that only the last rows have, nulls, empty and repeated tags."""
    n = F.col("id")
    df = spark.range(70_000).select(
        n.cast("string").alias("__id"),
        F.when(n % 7 != 0, F.concat(F.lit("c"), (n % 5).cast("string"))).alias("color"),
        (n % 11).cast("int").alias("size"),
        F.when(n % 3 == 0, (n % 4) / 2).alias("weight"),
        (n % 2 == 0).alias("new"),
        F.when(n % 13 != 0, F.array(F.lit("t"), (n % 3).cast("string"), F.lit("t"))).alias("Tags"),
    )
    rare = F.when(n >= 69_998, F.lit("rare")).otherwise(F.col("color"))
    df = spark.range(70_000).join(df.withColumn("id", F.col("__id").cast("long")), "id").withColumn("color", rare).drop("id")
    return numbered(df, FIELDS)


@pytest.fixture(scope="module")
def bitmaps(rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bitmaps") / "t")
    facet_bitmaps(rows, FIELDS).sort("field", "value").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


WHERES = [
    {},
    {"color": ["c1", "c2"]},
    {"Color": ["c1", "absent"], "size": ["3", "4", "5"], "new": ["True"]},
    {"tags": ["1"], "weight": ["0.5", "1"]},
    {"color": ["rare"]},
    {"color": ["absent"], "size": ["1"]},
    {"color": [], "size": ["2"]},
]


def test_against_facets_over_documents(rows, bitmaps):
    wanted, by_scan = [], []
    for i, where in enumerate(WHERES):
        node = And([Term(f, list(v)) for f, v in where.items()]) if where else None
        for f in FIELDS:
            wanted.append(BitmapFacet(f, f"{f}{i}", where))
            by_scan.append(TermFacet(f, f"{f}{i}", size=0, filter=node))
    found = sorted(map(tuple, bitmap_facets(bitmaps, wanted).drop("agg_pos").collect()))
    assert found == sorted(map(tuple, facets(rows, by_scan).drop("agg_pos").collect()))
    assert ("Tags1", "t", 0) not in found and any(r[0] == "color4" and r[1:] == ("rare", 2) for r in found)


def test_totals(rows, bitmaps):
    assert selected_total(bitmaps, WHERES[1]).first().total == rows.filter("color in ('c1', 'c2')").count()
    assert selected_total(bitmaps, {"color": ["absent"]}).first().total == 0
    with pytest.raises(FieldError):
        selected_total(bitmaps, {"color": []})


def test_halves_together_are_the_whole(rows, bitmaps):
    halves = [facet_bitmaps(rows.filter(F.col("__row") % 2 == r), ["color"]) for r in (0, 1)]
    assert merge_bitmaps(*halves).exceptAll(bitmaps.filter("field = 'color'")).count() == 0


def test_empty_and_unknown(spark, rows):
    none = facet_bitmaps(rows.limit(0), FIELDS)
    assert none.count() == 0 and bitmap_facets(none, [BitmapFacet("color", where={"size": ["1"]})]).count() == 0
    assert bitmap_facets(none, []).count() == 0
    with pytest.raises(FieldError):
        facet_bitmaps(rows, ["nothing"])


def test_only_bitmaps_in_use_are_read(bitmaps):
    plan = bitmap_facets(bitmaps, [BitmapFacet("color", where={"size": ["1"]})])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(field,") == 2 and "Python" not in plan
