"""Facet counts."""

from pyspark.sql import functions as F

from sieveline import FacetRange, Range, RangeFacet, RangeValue, Term, TermFacet, bucket_counts, facets

from .registry import SIZE_N_SQL, query, size_with_nulls, table


def counts(df, *requests):
    return facets(df, requests).drop("agg_pos")


def terms_sql(result_id: str, value: str, source: str = "part", where: str = "true") -> str:
    return f"""SELECT '{result_id}' AS aggregation_id, {value} AS value_id, count(*) AS count
        FROM {source} WHERE {where} AND ({value}) IS NOT NULL GROUP BY ALL"""


@query(terms_sql("P_Brand", "p_brand"))
def facet_term_string(spark, sf):
    return counts(table(spark, sf, "part"), TermFacet("P_Brand", size=0))


@query(terms_sql("size_n", "size_n::VARCHAR", SIZE_N_SQL))
def facet_term_numeric(spark, sf):
    return counts(size_with_nulls(table(spark, sf, "part")), TermFacet("size_n", size=0), TermFacet("unknown"))


@query(
    terms_sql("l_quantity", "l_quantity::BIGINT::VARCHAR", "lineitem")
    + " UNION ALL "
    + terms_sql("rate", "CASE l_discount WHEN 0 THEN '0' WHEN 0.1 THEN '0.1' ELSE l_discount::VARCHAR END", "lineitem")
    + " UNION ALL "
    + terms_sql("taxed", "CASE WHEN l_tax > 0 THEN 'True' ELSE 'False' END", "lineitem")
)
def facet_value_text(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("taxed", F.col("l_tax") > 0)
    return counts(
        df, TermFacet("l_quantity", size=0), TermFacet("l_discount", id="rate", size=0), TermFacet("taxed", size=0)
    )


@query("""SELECT 'tags' AS aggregation_id, value_id, count(*) AS count FROM
    (SELECT unnest(list_distinct(string_split(p_name || ' ' || p_type || ' ' || p_type, ' '))) AS value_id FROM part)
    GROUP BY ALL""")
def facet_collection(spark, sf):
    tags = F.split(F.concat_ws(" ", "p_name", "p_type", "p_type"), " ")
    return counts(table(spark, sf, "part").withColumn("tags", tags), TermFacet("tags", size=0))


def top_sql(inner: str, n: int) -> str:
    return f"""SELECT * FROM ({inner})
        QUALIFY row_number() OVER (PARTITION BY aggregation_id ORDER BY count DESC, value_id) <= {n}"""


@query(top_sql(terms_sql("p_brand", "p_brand") + " UNION ALL " + terms_sql("p_type", "p_type"), 3))
def facet_top_n(spark, sf):
    return counts(table(spark, sf, "part"), TermFacet("p_brand", size=3), TermFacet("p_type", size=3))


@query(top_sql(terms_sql("p_brand", "p_brand"), 10))
def facet_default_size(spark, sf):
    return counts(table(spark, sf, "part"), TermFacet("p_brand"))


@query(terms_sql("p_name", "p_name"))
def facet_all_values(spark, sf):
    return counts(table(spark, sf, "part"), TermFacet("p_name", size=0))


@query(terms_sql("p_brand", "p_brand", where="p_brand IN ('Brand#3', 'Brand#14')"))
def facet_specific_values(spark, sf):
    return counts(table(spark, sf, "part"), TermFacet("p_brand", values=["Brand#3", "Brand#14", "Brand#99"]))


@query("""SELECT 'segment' AS aggregation_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'Building' ELSE 'hOUSEhold' END AS value_id,
      count(*) AS count FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD') GROUP BY ALL""")
def facet_specific_ci(spark, sf):
    facet = TermFacet("c_mktsegment", id="segment", values=["Building", "hOUSEhold", "none"])
    return counts(table(spark, sf, "customer"), facet)


def range_sql(result_id: str, ranges: dict[str, str], source: str = "part", where: str = "true") -> str:
    parts = [
        f"""SELECT * FROM (SELECT '{result_id}' AS aggregation_id, '{name}' AS value_id, count(*) AS count
            FROM {source} WHERE {where} AND {test}) WHERE count > 0"""
        for name, test in ranges.items()
    ]
    return " UNION ALL ".join(parts)


SIZES = [FacetRange("small", "0", "5"), FacetRange("medium", "5", "20"), FacetRange("none", "500", "600")]


@query(range_sql("p_size", {"small": "p_size < 5", "medium": "p_size >= 5 AND p_size < 20", "none": "p_size > 500"}))
def facet_range(spark, sf):
    return counts(table(spark, sf, "part"), RangeFacet("P_Size", SIZES))


@query(range_sql("price", {"low": "p_retailprice < 950.5", "high": "p_retailprice >= 1000", "all": "true"}))
def facet_range_open(spark, sf):
    ranges = [FacetRange("low", "0", "950.5"), FacetRange("high", "1000", ""), FacetRange("all")]
    return counts(table(spark, sf, "part"), RangeFacet("p_retailprice", ranges, id="PRICE"))


@query("""SELECT bucket, CASE bucket WHEN 1 THEN '5' WHEN 2 THEN '20.5' WHEN 3 THEN '40' END AS lower,
      CASE bucket WHEN 0 THEN '5' WHEN 1 THEN '20.5' WHEN 2 THEN '40' END AS upper, count(*) AS count
    FROM (SELECT CASE WHEN p_size < 5 THEN 0 WHEN p_size < 20.5 THEN 1 WHEN p_size < 40 THEN 2 ELSE 3 END AS bucket FROM part)
    GROUP BY ALL""")
def facet_buckets(spark, sf):
    values = [FacetRange("a", "20.5", "40"), FacetRange("b", "5", "20.5"), FacetRange("c", "-1", "x")]
    return bucket_counts(table(spark, sf, "part"), "p_size", values)


MAIN = Term("p_brand", ["Brand#1", "Brand#2"])


@query(terms_sql("p_brand", "p_brand"))
def facet_ignores_filter(spark, sf):
    from sieveline import SearchRequest, search

    request = SearchRequest(filter=MAIN, facets=[TermFacet("p_brand", size=0)])
    return search(table(spark, sf, "part"), request).facets.drop("agg_pos")


@query(terms_sql("p_brand", "p_brand", where="p_size = 10") + " UNION ALL " + terms_sql("all", "p_type"))
def facet_own_filter(spark, sf):
    from sieveline import SearchRequest, search

    own = TermFacet("p_brand", size=0, filter=Term("p_size", ["10"]))
    request = SearchRequest(filter=MAIN, facets=[own, TermFacet("p_type", id="all", size=0)])
    return search(table(spark, sf, "part"), request).facets.drop("agg_pos")


@query(terms_sql("p_type", "p_type", where="p_brand IN ('Brand#1', 'Brand#2')"))
def facet_shared_filter(spark, sf):
    from sieveline import SearchRequest, search

    request = SearchRequest(filter=MAIN, facets=[TermFacet("p_type", size=0, filter=MAIN)])
    return search(table(spark, sf, "part"), request).facets.drop("agg_pos")


@query(range_sql("Big", {"Big": "p_size > 40"}) + " UNION ALL " + range_sql("Gone", {"Gone": "false"}))
def facet_filter_only(spark, sf):
    big = TermFacet(id="Big", filter=Range("p_size", [RangeValue("40")]))
    return counts(table(spark, sf, "part"), big, TermFacet(id="Gone", filter=Term("nowhere", ["x"])))


@query(f"""SELECT 0 AS agg_pos, * FROM ({top_sql(terms_sql("p_brand", "p_brand", where="p_size < 25"), 4)})
    UNION ALL SELECT 1, * FROM ({range_sql("sizes", {"small": "p_size < 5", "medium": "p_size >= 5 AND p_size < 20"})})
    UNION ALL SELECT 2, * FROM ({terms_sql("Kind", "p_type")})
    UNION ALL SELECT 4, * FROM ({range_sql("few", {"few": "p_brand = 'Brand#7'"})})""")
def facets_combined(spark, sf):
    requests = [
        TermFacet("p_brand", size=4, filter=Range("p_size", [RangeValue(upper="25")])),
        TermFacet(id="few", filter=Term("p_brand", ["Brand#7"])),
        RangeFacet("p_size", SIZES, id="Sizes"),
        TermFacet("p_type", id="Kind", size=0),
        TermFacet("no such field"),
    ]
    return facets(table(spark, sf, "part"), requests)
