"""Expected answers on the six sample documents."""

import pytest

from fixture import loaded_index
from sieveline import (
    And, FacetRange, GeoDistance, GeoSort, Ids, Not, Or, Range, RangeFacet, RangeValue, SearchRequest, SortField, Term,
    TermFacet,
)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    return loaded_index(spark, str(tmp_path_factory.mktemp("index")))


@pytest.fixture(scope="module")
def index(loaded):
    return loaded[0]


def ids(index, **request):
    return [r.id for r in index.search(SearchRequest(take=10, **request)).documents.collect()]


def total(index, node):
    return index.search(SearchRequest(take=0, filter=node)).total.first().total


def facet_rows(index, *facets, **request):
    rows = index.search(SearchRequest(facets=facets, **request)).facets.collect()
    return {(r.aggregation_id, r.value_id): r["count"] for r in rows}


def test_add_and_remove(loaded):
    first, second, removed = loaded[1]
    for report, count, action in ((first, 5, "inserted"), (second, 3, "inserted"), (removed, 2, "removed")):
        rows = report.collect()
        assert len(rows) == count
        assert all(r.succeeded and r.action == action and r.error_message is None for r in rows)


def test_paging(index):
    result = index.search(SearchRequest(skip=4, take=3))
    assert result.documents.count() == 2
    assert result.total.first().total == 6
    assert index.search(SearchRequest(take=0)).documents.count() == 0


def test_retrieved_fields(index):
    document = index.search(SearchRequest(take=10)).documents.first()
    assert document.catalog == ["Goods", "Stuff"]
    assert document.storedfield == "This value is only stored."
    assert document.numericcollection == 2  # first value only
    assert document.price_usd == 123.23
    assert document.location.coordinates == [0.0, 0.0]
    assert document.score == 1.0
    assert document.asDict()["date"].isoformat() == "2017-04-28T15:24:31.180000"


def test_new_fields_are_null_in_old_documents(index):
    rows = {r.id: r for r in index.search(SearchRequest(take=10)).documents.collect()}
    assert rows["Item-6"].name_2 == "Blue Shirt 2"
    assert rows["Item-6"].date__2_.isoformat() == "2020-01-01T00:00:00"
    assert rows["Item-1"].name_2 is None


def test_sort(index):
    def first(*sort):
        return index.search(SearchRequest(sort=sort, take=1)).documents.collect()[0].asDict()["name"]

    assert first(SortField("non-existent-field"), SortField("Name")) == "Black Sox"
    assert first(SortField("Name", True)) == "Sample Product"
    assert first(SortField("Size", True)) == "Black Sox2"


def test_geo_sort(index):
    near = [f"Item-{i}" for i in (2, 3, 1, 4, 5, 6)]
    assert ids(index, sort=[GeoSort("Location", 0, 14)]) == near
    assert ids(index, sort=[GeoSort("Location", 0, 14, True)]) == near[::-1]


def test_keywords(index):
    assert len(ids(index, text=" shirt ", fields=["Content"])) == 3
    assert len(ids(index, text="red shirt", fields=["Content"])) == 2
    assert len(ids(index, text="red shirt")) == 2
    assert len(ids(index, text="shrit", fuzzy=True)) == 3
    assert len(ids(index, text="shrit", fuzzy=True, fuzziness=1)) == 0
    assert len(ids(index, text="  ")) == 6


CASES = [
    (Ids(["Item-2", "Item-3", "Item-9"]), 2),
    (Ids([]), 6),
    (Ids(None), 6),
    (Term("non-existent-field", ["value-does-not-matter"]), 0),
    (Term("Color", ["non-existent-value-1", "non-existent-value-2"]), 0),
    (Term("Color", ["Red", "Blue", "Black"]), 5),
    (Term("Color", ["red"]), 0),
    (Term("Color", ["", None]), 6),
    (Term("Is", ["Red", "Blue", "Black"]), 5),
    (Term("Size", ["1", "2", "3"]), 2),
    (Term("Date", ["2017-04-29T15:24:31.180Z", "2017-04-28T15:24:31.180Z", "2017-04-27T15:24:31.180Z"]), 2),
    (Term("HasMultiplePrices", ["tRue"]), 2),
    (Term("HasMultiplePrices", ["fAlse"]), 4),
    (Range("non-existent-field", [RangeValue("0", "4")]), 0),
    (Range("Size", [RangeValue("0", "4"), RangeValue("", "4"), RangeValue(None, "4"), RangeValue("4", "10")]), 2),
    (Range("Size", [RangeValue("", None)]), 6),
    (GeoDistance("Location", 0, 14, 1110), 2),
    (Not(Term("Size", ["1", "2", "3"])), 4),
    (Not(Range("Size", [RangeValue("0", "4"), RangeValue("4", "20")])), 2),
    (Not(None), 6),
    (Not(Term("Color", [])), 6),
    (Not(Term("Name 2", ["Blue Shirt 2"])), 5),
    (Not(Term("non-existent-field", ["x"])), 6),
    (
        And([
            Term("Color", ["Red", "Blue", "Black"]),
            Range("Size", [RangeValue("0", "4"), RangeValue("4", "20", False, True)]),
        ]),
        4,
    ),
    (Or([Term("Color", ["Red"]), Range("Size", [RangeValue("10")])]), 4),
    (Or([Term("Color", ["Red"]), None, Ids([])]), 3),
    (Or([]), 6),
    (And(None), 6),
    (
        Or([
            Term("Color", ["Red"]),
            And([Not(Term("Color", ["Blue"])), Range("Size", [RangeValue(upper="20")])]),
        ]),
        4,
    ),
]


@pytest.mark.parametrize("node,expected", CASES, ids=range(len(CASES)))
def test_filters(index, node, expected):
    assert total(index, node) == expected


LOW, HIGH = "2017-04-23T15:24:31.180Z", "2017-04-28T15:24:31.180Z"


@pytest.mark.parametrize(
    "low,high,include_low,include_high,expected",
    [
        (LOW, HIGH, True, True, 6), (LOW, HIGH, False, True, 5), (LOW, HIGH, True, False, 5), (LOW, HIGH, False, False, 4),
        (None, HIGH, True, True, 6), (None, HIGH, True, False, 5), (LOW, None, True, False, 6), (LOW, None, False, False, 5),
    ],
)
def test_date_range(index, low, high, include_low, include_high, expected):
    assert total(index, Range("Date", [RangeValue(low, high, include_low, include_high)])) == expected


COLORS = ["Red", "Blue", "Black", "Silver"]
NARROW = And([Term("Color", ["Red", "Blue"]), Term("Size", ["2", "4"])])


def test_facet_sizes(index):
    assert facet_rows(index, TermFacet("Color", size=1)) == {("Color", "Red"): 3}
    assert facet_rows(index, TermFacet("Size", size=1)) == {("Size", "10"): 2}
    everything = facet_rows(index, TermFacet("non-existent-field", size=0), TermFacet("Color", size=0))
    assert everything == {("Color", "Red"): 3, ("Color", "Black"): 1, ("Color", "Blue"): 1, ("Color", "Silver"): 1}
    sizes = facet_rows(index, TermFacet("Size", size=0))
    assert sizes == {("Size", k): n for k, n in (("2", 1), ("3", 1), ("4", 1), ("10", 2), ("20", 1))}


def test_facet_values(index):
    chosen = facet_rows(index, TermFacet("x", values=["Red"]), TermFacet("Color", values=["Red", "Blue", "White"]))
    assert chosen == {("Color", "Red"): 3, ("Color", "Blue"): 1}
    assert facet_rows(index, TermFacet("Size", values=["3", "4", "5"])) == {("Size", "3"): 1, ("Size", "4"): 1}
    assert facet_rows(index, TermFacet("Color", values=[])) == {}
    assert facet_rows(index, TermFacet("HasMultiplePrices", size=0)) == {
        ("HasMultiplePrices", "True"): 2, ("HasMultiplePrices", "False"): 4,
    }


def test_range_facets(index):
    ranges = [FacetRange("5_to_20", "5", "20"), FacetRange("0_to_5", "0", "5")]
    found = facet_rows(index, RangeFacet("no", ranges[:1]), RangeFacet("Size", ranges))
    assert found == {("size", "0_to_5"): 3, ("size", "5_to_20"): 2}


def test_facets_and_filters(index):
    request = SearchRequest(facets=[TermFacet("Color", values=COLORS)], filter=NARROW, take=10)
    assert index.search(request).documents.count() == 2
    assert facet_rows(index, TermFacet("Color", values=COLORS), filter=NARROW) == {
        ("Color", "Red"): 3, ("Color", "Blue"): 1, ("Color", "Black"): 1, ("Color", "Silver"): 1,
    }
    own = TermFacet("Color", values=COLORS, filter=Term("Size", ["10"]))
    assert facet_rows(index, own, filter=NARROW) == {("Color", "Black"): 1, ("Color", "Blue"): 1}
    only = TermFacet(id="Filtered-Aggregation", filter=Term("Size", ["10"]))
    assert facet_rows(index, only, take=0) == {("Filtered-Aggregation", "Filtered-Aggregation"): 2}


def test_facet_counts_add_up_to_the_total(index):
    for text in (None, "shirt", "red"):
        result = index.search(SearchRequest(text=text, facets=[TermFacet("Color", size=0)]))
        assert sum(r["count"] for r in result.facets.collect()) == result.total.first().total


def test_raw_query(index):
    result = index.search(SearchRequest(text="nothing", raw="size = 10", facets=[TermFacet("Color")], take=10))
    assert [r.id for r in result.documents.collect()] == ["Item-4", "Item-6"]
    assert result.total.first().total is None
    assert result.facets.count() == 0  # facets stay under the text


def test_suggest(index):
    texts = lambda q, fields=("Name",), size=5: [r.text for r in index.suggest(q, fields, size).collect()]
    assert texts("bl") == ["Black Sox", "Black Sox2", "Blue Shirt"]
    assert texts("bl", size=1) == ["Black Sox"]
    assert texts("black so") == ["Black Sox", "Black Sox2"]
    assert texts("bla so") == []
    assert texts("bl", fields=()) == []


def test_get_by_ids(index):
    assert [r["__id"] for r in index.get(["Item-3", "Item-7"]).collect()] == ["Item-3"]


def test_ids_filter_reaches_the_reader(index):
    result = index.search(SearchRequest(filter=And([Ids(["Item-2", "Item-9"]), Term("Color", ["Red"])])))
    assert [r.id for r in result.documents.collect()] == ["Item-2"]
    assert result.total.first().total == 1
    assert "In(__id, [Item-2,Item-9])" in result.documents._jdf.queryExecution().executedPlan().toString()


def test_text_search_equals_a_scan_of_the_texts(index):
    from dataclasses import replace

    from sieveline import search

    base = SearchRequest(text="sh r", facets=[TermFacet("Color", size=0), TermFacet("Size", filter=Term("Color", ["Red"]))])
    requests = [
        base, replace(base, filter=Range("Size", [RangeValue("2")])), replace(base, sort=[SortField("Size", True)], take=2),
        replace(base, sort=[SortField("score"), SortField("Name")], skip=1), replace(base, text="shrit", fuzzy=True),
        replace(base, text="nothing"),
    ]
    for request in requests:
        got, want = index.search(request), search(index.table(), request)
        rows = lambda r: [(x.id, round(x.score, 9)) for x in r.documents.collect()]
        assert rows(got) == rows(want)
        assert got.total.first() == want.total.first()
        assert sorted(got.facets.collect()) == sorted(want.facets.collect())
