"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from sieveline import (
    KEY, And, GeoDistance, Not, Range, RangeFacet, FacetRange, RangeValue, SearchRequest, SortField, Term, TermFacet,
    apply_filter, facets, page, retrieve, search, sort, with_flags,
)
from sieveline.operators.postings import build_postings
from sieveline.sources.mutations import merge_update, remove, upsert


@pytest.fixture(scope="module")
def part(spark):
    return spark.read.parquet(f"{SF}/part.parquet").withColumn(KEY, F.col("p_partkey").cast("string"))


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "BatchEval" not in text
    return text


def test_filters_reach_the_reader(part):
    text = plan(apply_filter(part, And([Term("p_brand", ["Brand#1"]), Range("p_size", [RangeValue("3")])])))
    assert "EqualTo(p_brand,Brand#1)" in text and "GreaterThan(p_size,3)" in text


def test_negations_reach_the_reader(part):
    text = plan(apply_filter(part, Not(And([Term("p_brand", ["Brand#1"]), Range("p_size", [RangeValue("3")])]))))
    assert "Or(Not(EqualNullSafe(p_brand,Brand#1))" in text


def test_unknown_field_reads_nothing(part):
    assert "FileScan" not in plan(apply_filter(part, Term("nowhere", ["x"])))


def test_geo_box_reaches_the_reader(spark, tmp_path):
    places = spark.range(10).select(F.col("id").cast("double").alias("at_lat"), F.col("id").cast("double").alias("at_lon"))
    places.write.parquet(str(tmp_path / "p"))
    text = plan(apply_filter(spark.read.parquet(str(tmp_path / "p")), GeoDistance("at", 5, 5, 100)))
    assert "GreaterThanOrEqual(at_lat" in text and "LessThanOrEqual(at_lon" in text


def test_projection_prunes_columns(part):
    text = plan(retrieve(with_flags(part, "p_retailprice", retrievable=False)))
    assert "p_retailprice" not in text


def test_page_is_a_top_k(part):
    text = plan(page(sort(part, [SortField("p_name")]), 40, 10))
    assert "TakeOrderedAndProject(limit=50, offset=40" in text


def test_facets_share_one_scan_and_shuffle(part):
    requests = [TermFacet("p_brand", size=0), TermFacet("p_size", size=0), RangeFacet("p_size", [FacetRange("a", "1", "5")])]
    text = plan(facets(part, requests))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    assert "p_name" not in text
    assert "WindowGroupLimit" in plan(facets(part, [TermFacet("p_brand", size=3), TermFacet("p_size", size=0)]))


def test_facet_filters_reach_the_reader(part):
    text = plan(facets(part, [TermFacet("p_brand", filter=Term("p_size", ["7"]))]))
    assert "EqualTo(p_size,7)" in text


def test_search_neither_joins_nor_shuffles_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").withColumn(KEY, F.col("doc_id").cast("string"))
    result = search(documents, SearchRequest(text="the", fields=["text"], filter=Term("lang", ["en"])))
    text = plan(result.documents)
    assert "Join" not in text and "Exchange hashpartitioning" not in text
    assert "EqualTo(lang,en)" in text


@pytest.mark.parametrize("keys", [(), (SortField("n_chars", True),), (SortField("score"),)], ids=["default", "field", "score"])
def test_search_pages_are_top_k(spark, keys):
    documents = spark.read.parquet(f"{SF}/documents.parquet").withColumn(KEY, F.col("doc_id").cast("string"))
    result = search(documents, SearchRequest(text="the re", fields=["text"], sort=keys, skip=3, take=5))
    text = plan(result.documents.select("id", F.round("score", 6)))
    assert "TakeOrderedAndProject(limit=8, offset=3" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("change", [upsert, remove])
def test_small_changes_do_not_shuffle_the_table(part, change):
    batch = part.filter("p_partkey < 5").withColumn("seq", F.lit(1))
    text = plan(change(part, batch))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_small_partial_updates_do_not_shuffle_the_table(part):
    batch = part.filter("p_partkey < 5").select(KEY, "p_size", F.lit(1).alias("seq"), F.array(F.lit("p_size")).alias("present"))
    assert "SortMergeJoin" not in plan(merge_update(part, batch))
    assert "SortMergeJoin" in plan(merge_update(part, batch, limit=0))


def test_postings_need_one_shuffle_at_most(part):
    assert plan(build_postings(part, ["p_name"])).count("Exchange") == 1
    bucketed = part.withColumn("b", F.col("p_partkey") % 4).repartition("b")
    assert plan(build_postings(bucketed, ["p_name"], keep=("b", KEY))).count("Exchange") == 1


def test_key_made_of_a_number_reaches_the_reader(spark):
    from sieveline import Ids
    from sieveline.sources.documents import with_key

    orders = with_key(spark.read.parquet(f"{SF}/orders.parquet"), "o_orderkey")
    text = plan(apply_filter(orders, Ids(["5", "007", "x", "99"])))
    assert "In(o_orderkey, [5,99])" in text
    assert apply_filter(orders, Ids(["05", "x"])).count() == 0


def test_deep_pages_are_ranked_by_range(part, monkeypatch):
    from sieveline.operators import sorting

    monkeypatch.setattr(sorting, "DEEP_PAGE", 10)
    order = [F.col("p_name").asc(), F.col("p_partkey").asc()]
    wanted = [r.p_partkey for r in part.orderBy(*order).collect()]
    for skip, take in ((40, None), (150, 30), (0, 25)):
        found = page(part, skip, take, order)
        text = plan(found)
        assert "CollectLimit" not in text and "TakeOrdered" not in text and "GlobalLimit" not in text
        assert [r.p_partkey for r in found.collect()] == wanted[skip : None if take is None else skip + take]
    with pytest.raises(ValueError):
        page(part, 40)


def test_building_documents_does_not_sort_the_batch(spark):
    from sieveline.sources.documents import assemble, collect_specs, infer_fields, read_documents

    long = spark.range(20).selectExpr("string(id) doc_id", "id seq", "explode(transform(sequence(1, 500), i -> concat('F', i))) name",
                                      "'String' type", "array(string(id)) values")
    long = read_documents(long)
    fields = infer_fields(long)
    specs = collect_specs(fields)
    wide = assemble(long, specs)
    assert len(specs) == 500
    assert "SortAggregate" not in plan(fields) and "SortAggregate" not in plan(wide)
    assert wide.select("f1", "f500").distinct().count() == 20


def test_postings_are_scanned_and_shuffled_once(part, spark, tmp_path):
    from sieveline.operators.postings import field_lengths, search_postings

    build_postings(part, ["p_name"]).write.parquet(str(tmp_path / "p"))
    hits = search_postings(spark.read.parquet(str(tmp_path / "p")), field_lengths(part, ["p_name"]), "red", ["p_name"])
    hits.collect()
    text = hits._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text or text.count(str(tmp_path / "p")) == 1


def test_tokens_are_counted_in_one_shuffle(spark):
    from checks import REGISTRY

    assert plan(REGISTRY["tokenize_documents"].run(spark, SF)).count("Exchange hashpartitioning") == 1
