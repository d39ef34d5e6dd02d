"""Page, total and facets in one pass: the rows of the three frames, from one scan."""

import pytest
from pyspark.sql import functions as F

from sieveline import And, FacetRange, KEY, Range, RangeFacet, RangeValue, SearchRequest, SortField, Term, TermFacet, answer, search
from sieveline.operators.facets import known_counts

RANGES = RangeFacet("size", [FacetRange("low", upper="10"), FacetRange("same", "10", "20"), FacetRange("same", "15", "30")])
REQUESTED = TermFacet("size", id="wanted", size=0, values=["7", "8", "8", "99"])
ROWS = TermFacet(id="reds", filter=Term("color", ["red"]))
TEXTS = TermFacet("color", id="texts", size=0, values=["RED", "blue"])
OPEN = TermFacet("color", size=2, filter=Range("size", [RangeValue("5")]))
MAIN = Term("color", ["red", "Blue"])


@pytest.fixture(scope="module")
def table(spark):
    colors = F.element_at(F.array(*[F.lit(c) for c in ("red", "Red", "blue", "green")]), F.pmod(F.col("id"), F.lit(4)).cast("int") + 1)
    return spark.range(0, 300, 1, 6).select(
        F.col("id").cast("string").alias(KEY),
        F.when(F.col("id") % 11 > 0, colors).alias("color"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("size"),
        F.concat(F.lit("thing "), F.col("id") % 5).alias("name"),
    )


@pytest.mark.parametrize(
    "request_",
    [
        SearchRequest(filter=MAIN, sort=[SortField("size", True)], skip=3, take=7, facets=[RANGES, OPEN, ROWS, REQUESTED, TEXTS]),
        SearchRequest(text="thing 3", filter=And([MAIN, Range("size", [RangeValue("9")])]), facets=[REQUESTED]),
        SearchRequest(text="3", facets=[OPEN, TEXTS]),
        SearchRequest(text="nowhere", facets=[RANGES, OPEN]),
        SearchRequest(filter=Term("no field", ["x"]), facets=[ROWS, RANGES]),
        SearchRequest(filter=MAIN, take=0, facets=[ROWS]),
        SearchRequest(filter=MAIN, skip=1000),
        SearchRequest(raw="size > 20", text="3", sort=[SortField("size")], facets=[RANGES, TEXTS]),
    ],
)
def test_same_rows_as_the_three_frames(table, request_):
    found, wanted = answer(table, request_), search(table, request_)
    assert found.documents == wanted.documents.collect()
    assert found.total == wanted.total.first().total
    assert sorted(found.facets) == sorted(wanted.facets.collect())


def test_empty_table(table):
    found = answer(table.limit(0), SearchRequest(text="3", filter=MAIN, facets=[RANGES, ROWS, OPEN]))
    assert (found.documents, found.total, found.facets) == ([], 0, [])
    empty = table.sparkSession.createDataFrame([], table.schema)
    found = answer(empty, SearchRequest(filter=MAIN, facets=[RANGES]))
    assert (found.documents, found.total, found.facets) == ([], 0, [])


def test_pages_without_an_end_are_refused(table):
    for request in (SearchRequest(take=None), SearchRequest(skip=100_000, take=1)):
        with pytest.raises(ValueError):
            answer(table, request)


def test_requested_texts_are_left_to_an_aggregation(table):
    assert known_counts(table.schema, [TEXTS, OPEN, TermFacet("size", size=1, values=["7"])]) == []
    assert [k[2] for k in known_counts(table.schema, [REQUESTED, ROWS])] == ["7", "8", "99", "reds"]


def test_one_job_without_a_shuffle(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    rows = spark.read.schema(table.schema).parquet(str(tmp_path / "t"))
    sc = spark.sparkContext
    sc.setJobGroup("one-answer", "")
    try:
        found = answer(rows, SearchRequest(filter=MAIN, sort=[SortField("size")], take=5, facets=[RANGES, ROWS, REQUESTED]))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = sc.statusTracker().getJobIdsForGroup("one-answer")
    assert len(jobs) == 1 and len(found.documents) == 5 and found.facets
    assert len(sc.statusTracker().getJobInfo(jobs[0]).stageIds) == 1
