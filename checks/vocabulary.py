"""The standard tokenizer, windows of many terms, and tokens found through tables of their parts."""

from pyspark.sql import functions as F

from sieveline import KEY, STANDARD_WORDS, AllOf, Analysis, Fuzzy, Match, NearAll, Wildcard, field_match, score, search_text
from sieveline.functions import text as tx
from sieveline.operators import vocabulary as vocab
from sieveline.operators.postings import token_keys
from sieveline.operators.query import query_condition
from sieveline.sizing import staged

from .registry import hits_sql, query, standard_sql, table, tokens_sql

STANDARD = Analysis("word", words=STANDARD_WORDS)


@query(f"""SELECT token, count(*) AS n, count(DISTINCT doc_id) AS docs
    FROM (SELECT doc_id, unnest({standard_sql('text')}) AS token FROM documents) GROUP BY token""")
def tokenize_standard(spark, sf):
    text = STANDARD_WORDS.prepared(tx.fold(F.col("text")))
    tokens = table(spark, sf, "documents").select(tx.tokens(text, STANDARD_WORDS).alias("tokens"))
    counted = lambda n, docs: lambda t: F.struct(t.alias("token"), F.lit(n).alias("n"), F.lit(docs).alias("docs"))
    pairs = F.concat(F.transform("tokens", counted(1, 0)), F.transform(F.array_distinct("tokens"), counted(0, 1)))
    return tokens.select(F.inline(pairs)).groupBy("token").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# Names with apostrophes, prices as decimals, and ideographs.
LABEL_SQL = "p_name || '''s ' || p_retailprice::DECIMAL(12, 2)::VARCHAR || ' 大小' || p_size || ':' || p_brand"


def labelled(spark, sf):
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    label = F.concat("p_name", F.lit("'s "), price, F.lit(" 大小"), F.col("p_size").cast("string"), F.lit(":"), F.col("p_brand"))
    return table(spark, sf, "part").select(KEY, "p_partkey", label.alias("label"))


def standard_hits(test: str) -> str:
    return f"len(list_filter({standard_sql(LABEL_SQL)}, lambda x: {test})) > 0"


@query(f"""SELECT p_partkey, {LABEL_SQL} AS label FROM part WHERE ({standard_hits("x = 'widget''s'")} OR {standard_hits("x = '大'")} AND {standard_hits("x = '7'")})
    AND {standard_hits("starts_with(x, '9')")} AND NOT {standard_hits("x LIKE '9%.99'")}""")
def match_standard(spark, sf):
    df = labelled(spark, sf)
    text = AllOf(Match("9"))
    condition = (
        (query_condition(df.schema, AllOf(Match("widget's")), ["label"], STANDARD) | query_condition(df.schema, "大 7", ["label"], STANDARD))
        & query_condition(df.schema, text, ["label"], Analysis(words=STANDARD_WORDS))
        & ~query_condition(df.schema, Wildcard("9*.99"), ["label"], STANDARD)
    )
    return df.filter(condition).select("p_partkey", "label")


@query(f"""WITH toks AS (SELECT doc_id, {standard_sql('text')} AS toks FROM documents),
    tf AS (SELECT *, len(list_filter(toks, lambda x: x = 'the')) AS a, len(list_filter(toks, lambda x: x = 'of')) AS b FROM toks),
    stats AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM tf)
    SELECT doc_id, round(ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * len(toks) / avgdl))
        + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * len(toks) / avgdl)), 6) AS score
    FROM tf, stats WHERE a > 0 AND b > 0""")
def score_standard(spark, sf):
    df = table(spark, sf, "documents")
    hits = score(search_text(df, "the of", ["text"], STANDARD), "the of", ["text"], STANDARD, corpus=df)
    return hits.select("doc_id", F.round("score", 6).alias("score"))


def window_sql(terms: list[str], slop: int) -> str:
    """Documents with a place of each term, all different, within a window."""
    n = len(terms)
    tables = ", ".join(f"pos t{k}" for k in range(n))
    conditions = [f"t{k}.token = '{t}'" for k, t in enumerate(terms)] + [f"t{k}.doc_id = t0.doc_id" for k in range(1, n)]
    conditions += [f"t{a}.i <> t{b}.i" for a in range(n) for b in range(a)]
    # Each place near the first one: a join on places would be as wide as the text.
    conditions += [f"abs(t{k}.i - t0.i) < {n + slop}" for k in range(1, n)]
    places = ", ".join(f"t{k}.i" for k in range(n))
    return f"""WITH toks AS (SELECT doc_id, {tokens_sql('text')} AS toks FROM documents),
      every AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS i FROM toks),
      pos AS (SELECT * FROM every WHERE token IN ({", ".join(f"'{t}'" for t in terms)}))
      SELECT doc_id, lang FROM documents WHERE doc_id IN (
        SELECT t0.doc_id FROM {tables} WHERE {" AND ".join(conditions)} AND greatest({places}) - least({places}) + 1 - {n} <= {slop})"""


@query(window_sql(["the", "of", "with"], 4))
def match_window(spark, sf):
    return field_match(table(spark, sf, "documents"), "text", tx.proximity_match, ["the", "of", "with"], 4).select("doc_id", "lang")


@query(window_sql(["the", "the", "of"], 3))
def match_window_repeated(spark, sf):
    df = table(spark, sf, "documents")
    return df.filter(query_condition(df.schema, NearAll("the", "of", "The", slop=3), ["text"])).select("doc_id", "lang")


def corpus(spark, sf):
    """(token, key) of all documents, written once: the tokens, their tables and the documents come from it."""
    return staged(token_keys(table(spark, sf, "documents"), ["text"]), "postings")


def ids(postings, tokens):
    return vocab.documents_with(postings, tokens).select(F.col(KEY).cast("long").alias("doc_id"))


@query(f"SELECT doc_id FROM documents WHERE {hits_sql('text', "levenshtein(x, 'onheedd') <= 2")} > 0")
def search_fuzzy_deletions(spark, sf):
    postings = corpus(spark, sf)
    parts = vocab.deletion_table(vocab.vocabulary(postings))
    return ids(postings, vocab.fuzzy_tokens(parts, ["onheedd"]))


@query(f"""SELECT token FROM (SELECT DISTINCT unnest({tokens_sql('text')}) AS token FROM documents)
    WHERE damerau_levenshtein(token, 'hetat') <= 1 OR damerau_levenshtein(token, 'htea') <= 1""")
def fuzzy_swapped_tokens(spark, sf):
    # The tokens are asked for and no documents: read once, so nothing is written before.
    postings = token_keys(table(spark, sf, "documents"), ["text"])
    parts = vocab.deletion_table(vocab.vocabulary(postings), 1)
    return vocab.fuzzy_tokens(parts, ["hetat", "htea"], Fuzzy(1, transpositions=True)).select("token").distinct()


@query(f"SELECT doc_id FROM documents WHERE {hits_sql('text', "contains(x, 'heit')")} > 0")
def search_infix_grams(spark, sf):
    postings = corpus(spark, sf)
    tokens = vocab.vocabulary(postings)
    return ids(postings, vocab.infix_tokens(tokens, vocab.gram_table(tokens), "Heit"))


@query(f"SELECT doc_id FROM documents WHERE {hits_sql('text', "x LIKE 'the%_er'")} > 0")
def search_wildcard_grams(spark, sf):
    postings = corpus(spark, sf)
    tokens = vocab.vocabulary(postings)
    return ids(postings, vocab.wildcard_tokens(tokens, vocab.gram_table(tokens), "the*?er"))


@query(f"SELECT doc_id FROM documents WHERE {hits_sql('text', "regexp_full_match(x, 'ver(heit|[a-z]+keit)|(ent)+..')")} > 0")
def search_regex_grams(spark, sf):
    postings = corpus(spark, sf)
    tokens = vocab.vocabulary(postings)
    return ids(postings, vocab.regex_tokens(tokens, vocab.gram_table(tokens), "ver(heit|[a-z]+keit)|(ent)+.."))
