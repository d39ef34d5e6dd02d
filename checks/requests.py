"""Composite search requests."""

from dataclasses import replace

from pyspark.sql import functions as F

from sieveline import (
    AllOf,
    Analysis,
    AnyOf,
    FacetRange,
    Boost,
    Match,
    NoneOf,
    Phrase,
    Range,
    RangeFacet,
    RangeValue,
    SearchRequest,
    SortField,
    Term,
    TermFacet,
    Wildcard,
    answer,
    search,
)

from sieveline.sources.documents import FieldOf, to_long

from .documents import new_index
from .registry import hits_sql, one, query, table
from .text import bm25_sql

REQUEST = SearchRequest(
    text="the re",
    fields=["text"],
    filter=Range("n_chars", [RangeValue("400", "9000", True)]),
    skip=5,
    take=15,
    facets=[TermFacet("lang", size=0), TermFacet("source", size=5, filter=Term("lang", ["en"]))],
)

MATCH = f"""{hits_sql('text', "starts_with(x, 'the')")} > 0 AND {hits_sql('text', "starts_with(x, 're')")} > 0"""


DOCUMENTS_SQL = bm25_sql(["the", "re"]).replace("lang, source,", "lang, source, n_chars,") + """
    SELECT doc_id::VARCHAR AS id, lang, source, n_chars, round(score, 6) AS score FROM scored
    WHERE tf0 > 0 AND tf1 > 0 AND n_chars >= 400 AND n_chars < 9000
    ORDER BY scored.score DESC, doc_id::VARCHAR LIMIT 15 OFFSET 5"""


def run(spark, sf, request=REQUEST):
    return search(table(spark, sf, "documents"), request)


@query(DOCUMENTS_SQL)
def search_documents(spark, sf):
    return run(spark, sf).documents.select("id", "lang", "source", "n_chars", F.round("score", 6).alias("score"))


@query(bm25_sql(["the", "re"]).replace("lang, source,", "lang, source, n_chars,") + """
    SELECT doc_id::VARCHAR AS id, n_chars, round(score, 6) AS score FROM scored
    WHERE tf0 > 0 AND tf1 > 0 AND n_chars >= 400 AND n_chars < 9000
    ORDER BY n_chars DESC, doc_id::VARCHAR LIMIT 10""")
def search_sorted(spark, sf):
    request = replace(REQUEST, sort=[SortField("N_Chars", True)], skip=0, take=10)
    return run(spark, sf, request).documents.select("id", "n_chars", F.round("score", 6).alias("score"))


@query(f"SELECT count(*) AS total FROM documents WHERE {MATCH} AND n_chars >= 400 AND n_chars < 9000")
def search_total(spark, sf):
    return run(spark, sf).total


@query(f"""SELECT 0 AS agg_pos, 'lang' AS aggregation_id, lang AS value_id, count(*) AS count FROM documents WHERE {MATCH} GROUP BY ALL
    UNION ALL (SELECT 1, 'source', source, count(*) AS count FROM documents WHERE {MATCH} AND lang = 'en' GROUP BY ALL
    ORDER BY count DESC, source LIMIT 5)""")
def search_facets(spark, sf):
    return run(spark, sf).facets


@query("""SELECT doc_id::VARCHAR AS id, lang, n_chars FROM documents WHERE lang = 'de' AND n_chars % 2 = 0
    ORDER BY n_chars, doc_id::VARCHAR LIMIT 20""")
def search_raw(spark, sf):
    request = SearchRequest(text="ignored", raw="lang = 'de' AND n_chars % 2 = 0", sort=[SortField("n_chars")])
    return run(spark, sf, request).documents.select("id", "lang", "n_chars")


@query(f"""SELECT count(*) AS total FROM documents WHERE {hits_sql('text', "contains(x, 'nter')")} > 0 AND lang = 'en'""")
def search_ngram_total(spark, sf):
    request = SearchRequest(text="nter", fields=["text"], filter=Term("lang", ["en"]))
    return search(table(spark, sf, "documents"), request, Analysis("ngram")).total


@query(bm25_sql(["the", "re"]).replace("lang, source,", "lang, source, n_chars,") + """
    SELECT doc_id::VARCHAR AS id, n_chars AS score, round(score, 6) AS relevance FROM scored WHERE tf0 > 0 AND tf1 > 0
    ORDER BY n_chars DESC, doc_id::VARCHAR LIMIT 10""")
def search_own_score(spark, sf):
    df = table(spark, sf, "documents").withColumnRenamed("n_chars", "score")
    request = SearchRequest(text="the re", fields=["text"], sort=[SortField("score", True)], take=10)
    found = search(df, request).documents
    return found.select("id", "score", F.round("__score", 6).alias("relevance"))


FIXED = [
    RangeFacet("n_chars", [FacetRange("short", upper="400"), FacetRange("middle", "400", "3000"), FacetRange("long", "3000")]),
    TermFacet("doc_id", id="some", size=0, values=["3", "50", "-1"]),
    TermFacet(id="german", filter=Term("lang", ["de"])),
    TermFacet("lang", size=0),
]


def answered(spark, sf):
    return answer(table(spark, sf, "documents"), replace(REQUEST, facets=FIXED))


@query(DOCUMENTS_SQL.replace("SELECT doc_id::VARCHAR AS id, lang, source, n_chars,", f"""SELECT doc_id::VARCHAR AS id,
    (SELECT count(*) FROM scored WHERE tf0 > 0 AND tf1 > 0 AND n_chars >= 400 AND n_chars < 9000) AS total,"""))
def answer_page(spark, sf):
    found = answered(spark, sf)
    rows = [(r.id, round(r.score, 6), found.total) for r in found.documents]
    return spark.createDataFrame(rows, "id string, score double, total bigint")


@query(f"""SELECT * FROM (
    SELECT 0 AS agg_pos, 'n_chars' AS aggregation_id, CASE WHEN n_chars < 400 THEN 'short' WHEN n_chars < 3000 THEN 'middle' ELSE 'long' END AS value_id,
      count(*) AS count FROM documents WHERE {MATCH} GROUP BY ALL
    UNION ALL SELECT 1, 'some', doc_id::VARCHAR, count(*) FROM documents WHERE {MATCH} AND doc_id IN (3, 50) GROUP BY ALL
    UNION ALL SELECT 2, 'lang', lang, count(*) FROM documents WHERE {MATCH} AND lang IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 3, 'german', 'german', count(*) FROM documents WHERE {MATCH} AND lang = 'de') WHERE count > 0""")
def answer_facets(spark, sf):
    return spark.createDataFrame(answered(spark, sf).facets, "agg_pos int, aggregation_id string, value_id string, count bigint")


def tree_sql(tfs: list[str], where: str, weights: list[float] | None = None) -> str:
    """BM25 of the leaves with the given counts over the token array ``toks``."""
    given = bm25_sql([f"leaf{i}" for i in range(len(tfs))], weights)
    for i, tf in enumerate(tfs):
        given = given.replace(f"len(list_filter(toks, lambda x: starts_with(x, 'leaf{i}'))) AS tf{i}", f"{tf} AS tf{i}")
    return given + f""" SELECT doc_id::VARCHAR AS id, lang, round(score, 6) AS score FROM scored WHERE {where}
        ORDER BY scored.score DESC, doc_id::VARCHAR LIMIT 20"""


def with_tree(spark, sf, tree, df=None):
    request = SearchRequest(text=tree, fields=["text"])
    found = search(table(spark, sf, "documents") if df is None else df, request).documents
    return found.select("id", "lang", F.round("score", 6).alias("score"))


STARTS = "len(list_filter(toks, lambda x: starts_with(x, '{}')))"


@query(tree_sql([STARTS.format("shat"), STARTS.format("que")], "tf0 > 0 OR tf1 > 0"))
def search_any_terms(spark, sf):
    return with_tree(spark, sf, AnyOf(Match("shat"), Match("Que")))


@query(tree_sql([STARTS.format("the")], f"tf0 > 0 AND {STARTS.format('sho')} = 0"))
def search_without_term(spark, sf):
    return with_tree(spark, sf, AllOf(Match("the"), NoneOf(Match("sho"))))


@query(tree_sql(["len(list_filter(range(1, len(toks)), lambda i: toks[i] = 'of' AND toks[i + 1] = 'the'))"], "tf0 > 0"))
def search_phrase_scored(spark, sf):
    return with_tree(spark, sf, Phrase("Of the"))


@query(tree_sql(["len(list_filter(toks, lambda x: x LIKE 'th%ing'))", "len(list_filter(toks, lambda x: x LIKE '_n'))"], "tf0 > 0 AND tf1 > 0"))
def search_wildcard_scored(spark, sf):
    return with_tree(spark, sf, AllOf(Wildcard("th*ing"), Wildcard("?n")))


BOOSTED = AllOf(Match("the"), Boost(Match("re"), 3.5))


@query(tree_sql([STARTS.format("the"), STARTS.format("re")], "tf0 > 0 AND tf1 > 0", [1.0, 3.5]))
def search_boosted_request(spark, sf):
    return with_tree(spark, sf, BOOSTED)


@query(tree_sql([STARTS.format("the"), STARTS.format("re")], "tf0 > 0 AND tf1 > 0", [1.0, 3.5]))
def index_search_tree(spark, sf):
    index = new_index(spark, "Tree")
    fields = {"Text": FieldOf(one("text"), searchable=True, retrievable=False), "Lang": FieldOf(one("lang"))}
    index.index(to_long(table(spark, sf, "documents"), F.col("doc_id"), F.col("doc_id"), fields))
    found = index.search(SearchRequest(text=BOOSTED, fields=["text"])).documents
    return found.select("id", "lang", F.round("score", 6).alias("score"))


@query(DOCUMENTS_SQL)
def index_search(spark, sf):
    df = table(spark, sf, "documents")
    fields = {
        "Text": FieldOf(one("text"), searchable=True, filterable=False, retrievable=False),
        "Lang": FieldOf(one("lang")),
        "Source": FieldOf(one("source")),
        "N Chars": FieldOf(one("n_chars"), "Long"),
    }
    index = new_index(spark, "Search")
    index.index(to_long(df, F.col("doc_id"), F.col("doc_id"), fields))
    request = replace(REQUEST, filter=Range("n chars", REQUEST.filter.values))
    return index.search(request).documents.withColumn("score", F.round("score", 6))
