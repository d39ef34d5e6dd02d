"""Text analysis, matching, scoring and suggestions."""

import uuid

from pyspark.sql import functions as F

from sieveline import KEY, Analysis, Fuzzy, SortField, field_match, page, score, search_text, sort, suggest, with_flags
from sieveline.functions import text as tx
from sieveline.operators.postings import build_postings, field_lengths, search_postings

from sieveline.sizing import work_folder

from .registry import hits_sql, query, table, tokens_sql

PART = ["p_partkey", "p_name"]
DOC = ["doc_id", "lang"]


@query(f"""SELECT token, count(*) AS n, count(DISTINCT doc_id) AS docs
    FROM (SELECT doc_id, unnest({tokens_sql('text')}) AS token FROM documents) GROUP BY token""")
def tokenize_documents(spark, sf):
    tokens = table(spark, sf, "documents").select(tx.tokens(tx.fold(F.col("text"))).alias("tokens"))
    # A document is one row: which of its tokens are distinct is known before any shuffle.
    counted = lambda n, docs: lambda t: F.struct(t.alias("token"), F.lit(n).alias("n"), F.lit(docs).alias("docs"))
    pairs = F.concat(F.transform("tokens", counted(1, 0)), F.transform(F.array_distinct("tokens"), counted(0, 1)))
    return tokens.select(F.inline(pairs)).groupBy("token").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


@query(f"SELECT p_partkey, p_name FROM part WHERE {hits_sql('p_name', "starts_with(x, 'wid')")} > 0")
def match_edge_ngram(spark, sf):
    return field_match(table(spark, sf, "part"), "P_Name", tx.prefix_match, "Wid").select(PART)


@query(f"SELECT p_partkey, p_name FROM part WHERE {hits_sql('p_name', "contains(x, 'olt')")} > 0")
def match_ngram(spark, sf):
    return field_match(table(spark, sf, "part"), "p_name", tx.infix_match, "olt").select(PART)


@query(f"SELECT p_partkey, p_name FROM part WHERE {hits_sql('p_name', "x = 'gear'")} > 0")
def match_word(spark, sf):
    return field_match(table(spark, sf, "part"), "p_name", tx.word_match, "gear").select(PART)


@query(f"""SELECT gram, count(*) AS n FROM (SELECT unnest(flatten(list_transform({tokens_sql('p_name')},
      lambda x: list_transform(generate_series(1, least(20, length(x))), lambda n: substring(x, 1, n::INT))))) AS gram FROM part)
    GROUP BY gram""")
def edge_ngrams(spark, sf):
    return _count_grams(table(spark, sf, "part"), lambda tokens: tx.ngrams(tokens, 1, 20, edge=True))


@query(f"""SELECT gram, count(*) AS n FROM (SELECT unnest(flatten(list_transform({tokens_sql('p_name')},
      lambda x: flatten(list_transform(generate_series(1, length(x) - 1), lambda i: list_transform(
        generate_series(2, least(4, length(x) - i + 1)), lambda n: substring(x, i::INT, n::INT))))))) AS gram FROM part)
    GROUP BY gram""")
def ngrams(spark, sf):
    return _count_grams(table(spark, sf, "part"), lambda tokens: tx.ngrams(tokens, 2, 4, edge=False))


def _count_grams(df, grams):
    """Tokens are counted first, so that every distinct one is taken apart once."""
    tokens = df.select(F.explode(tx.tokens(tx.fold(F.col("p_name")))).alias("token"))
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.explode(grams(F.array("token"))).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))


@query(f"""SELECT doc_id, lang FROM documents
    WHERE {hits_sql('text', "starts_with(x, 'the')")} > 0 AND {hits_sql('text', "starts_with(x, 're')")} > 0""")
def search_all_terms(spark, sf):
    return search_text(table(spark, sf, "documents"), " The re ", ["text"]).select(DOC)


@query(f"""SELECT p_partkey, p_name, p_type FROM part
    WHERE ({hits_sql('p_name', "starts_with(x, 'sma')")} > 0 OR {hits_sql('p_type', "starts_with(x, 'sma')")} > 0)
      AND ({hits_sql('p_name', "starts_with(x, 'bolt')")} > 0 OR {hits_sql('p_type', "starts_with(x, 'bolt')")} > 0)""")
def search_multi_field(spark, sf):
    return search_text(table(spark, sf, "part"), "sma bolt", ["p_name", "p_type"]).select("p_partkey", "p_name", "p_type")


@query(f"""SELECT p_partkey, p_name, p_type FROM part
    WHERE ({hits_sql('p_name', "contains(x, 'old')")} > 0 OR {hits_sql('p_type', "contains(x, 'old')")} > 0)
      AND ({hits_sql('p_name', "contains(x, 'mo')")} > 0 OR {hits_sql('p_type', "contains(x, 'mo')")} > 0)""")
def search_ngram_fields(spark, sf):
    df = search_text(table(spark, sf, "part"), "old mo", ["p_name", "p_type"], Analysis("ngram", 2, 5))
    return df.select("p_partkey", "p_name", "p_type")


@query(f"SELECT p_partkey, p_name FROM part WHERE {hits_sql('p_name', "levenshtein(x, 'wigdet') <= 2")} > 0")
def search_fuzzy(spark, sf):
    return search_text(table(spark, sf, "part"), "wigdet", ["p_name"], Fuzzy()).select(PART)


@query(f"SELECT p_partkey, p_name FROM part WHERE {hits_sql('p_name', "levenshtein(x, 'bolts') <= 1")} > 0")
def search_fuzzy_level1(spark, sf):
    return search_text(table(spark, sf, "part"), "bolts", ["p_name"], Fuzzy(1)).select(PART)


@query(f"SELECT doc_id, lang FROM documents WHERE {hits_sql('text', "levenshtein(x, 'onheedd') <= 2")} > 0")
def search_fuzzy_documents(spark, sf):
    return search_text(table(spark, sf, "documents"), "onheedd", ["text"], Fuzzy()).select(DOC)


def bm25_sql(terms: list[str], weights: list[float] | None = None) -> str:
    """Common table expressions ending in ``scored(doc_id, lang, source, score, tf0, ...)``."""
    weights = weights or [1.0] * len(terms)
    tfs = ", ".join(f"len(list_filter(toks, lambda x: starts_with(x, '{t}'))) AS tf{i}" for i, t in enumerate(terms))
    hits = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(terms)))
    parts = " + ".join(
        f"{w} * ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * len(toks) / avgdl))"
        for i, w in enumerate(weights)
    )
    return f"""WITH toks AS (SELECT doc_id, lang, source, {tokens_sql('text')} AS toks FROM documents),
      tf AS (SELECT *, {tfs} FROM toks),
      stats AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl, {hits} FROM tf),
      scored AS (SELECT tf.*, {parts} AS score FROM tf, stats)"""


@query(bm25_sql(["the", "re"]) + " SELECT doc_id, round(score, 6) AS score FROM scored WHERE tf0 > 0 AND tf1 > 0")
def score_bm25(spark, sf):
    df = table(spark, sf, "documents")
    hits = score(search_text(df, "the re", ["text"]), "the re", ["text"], corpus=df)
    return hits.select("doc_id", F.round("score", 6).alias("score"))


@query(bm25_sql(["the", "re"]) + " SELECT doc_id::VARCHAR AS __id, round(score, 6) AS score FROM scored WHERE tf0 > 0 AND tf1 > 0",
       name="search_postings")
def score_from_postings(spark, sf):
    df = table(spark, sf, "documents")
    folder = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    sorted_tokens = build_postings(df, ["text"]).repartitionByRange("field", "token", KEY)
    # By the token first: one field is often all there is, and the sort compares first columns fastest.
    sorted_tokens.sortWithinPartitions("token", "field").write.parquet(f"{folder}/postings")
    field_lengths(df, ["text"]).write.parquet(f"{folder}/lengths")
    postings, lengths = (spark.read.parquet(f"{folder}/{part}") for part in ("postings", "lengths"))
    hits = search_postings(postings, lengths, "the re", ["text"])
    return hits.withColumn("score", F.round("score", 6))


@query(bm25_sql(["the", "re"], [1.0, 3.5]) + " SELECT doc_id, round(score, 6) AS score FROM scored")
def score_boosted(spark, sf):
    df = score(table(spark, sf, "documents"), "the re", ["text"], boosts={"re": 3.5})
    return df.select("doc_id", F.round("score", 6).alias("score"))


@query(bm25_sql(["th", "ou"]) + """ SELECT doc_id, round(score, 6) AS score FROM scored WHERE tf0 > 0 AND tf1 > 0
    ORDER BY round(score, 6) DESC, doc_id LIMIT 20""")
def sort_score(spark, sf):
    df = table(spark, sf, "documents")
    hits = score(search_text(df, "th ou", ["text"]), "th ou", ["text"], corpus=df)
    hits = hits.withColumn("score", F.round("score", 6))
    return page(sort(hits, [SortField("score", True)], ["doc_id"]), 0, 20).select("doc_id", "score")


@query(f"""SELECT DISTINCT p_name AS text FROM part
    WHERE {hits_sql('p_name', "x = 'red'")} > 0 AND {hits_sql('p_name', "starts_with(x, 'g')")} > 0
    ORDER BY p_name LIMIT 5""", name="suggest")
def suggest_names(spark, sf):
    return suggest(with_flags(table(spark, sf, "part"), "p_name", suggestable=True), "Red g", ["P_Name"], 5)


@query(f"""SELECT p_partkey, p_type FROM part WHERE {hits_sql('p_type', "starts_with(x, 'pro')")} > 0""")
def match_field_scoped(spark, sf):
    return field_match(table(spark, sf, "part"), "p_type", tx.prefix_match, "pro").select("p_partkey", "p_type")


@query(f"""SELECT p_partkey, p_name FROM part
    WHERE {hits_sql('p_name', "x LIKE 'w%t'")} > 0 OR {hits_sql('p_name', "x LIKE '_o_'")} > 0""")
def match_wildcard(spark, sf):
    df = table(spark, sf, "part")
    name = tx.fold(F.col("p_name"))
    return df.filter(tx.wildcard_match(name, "w*t") | tx.wildcard_match(name, "?o?")).select(PART)


def near_sql(terms: list[str], slop: int) -> str:
    first, second = terms
    apart = f"abs(i - j) - 1 <= {slop}" if slop else "j = i + 1"
    return f"""WITH toks AS (SELECT doc_id, lang, {tokens_sql('text')} AS toks FROM documents),
      pos AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS i FROM toks)
      SELECT doc_id, lang FROM documents WHERE doc_id IN (
        SELECT a.doc_id FROM (SELECT doc_id, i FROM pos WHERE token = '{first}') a
        JOIN (SELECT doc_id, i AS j FROM pos WHERE token = '{second}') b ON a.doc_id = b.doc_id AND {apart})"""


@query(near_sql(["with", "the"], 2))
def match_proximity(spark, sf):
    return field_match(table(spark, sf, "documents"), "text", tx.proximity_match, ["with", "The"], 2).select(DOC)


@query(near_sql(["of", "the"], 0))
def match_phrase(spark, sf):
    return field_match(table(spark, sf, "documents"), "text", tx.proximity_match, ["of", "the"]).select(DOC)


@query(f"SELECT p_partkey, p_name FROM part WHERE {hits_sql('p_name', "regexp_full_match(x, 'b.*t|r[aeiou]d')")} > 0")
def match_regex(spark, sf):
    return field_match(table(spark, sf, "part"), "p_name", tx.regex_match, "b.*t|r[aeiou]d").select(PART)
