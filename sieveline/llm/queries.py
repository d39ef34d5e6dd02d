"""Registered queries of this package with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sieveline.llm import (
    bpe,
    chat,
    curriculum,
    decontaminate,
    exact_dedup as dedup,
    hash_tree,
    language,
    line_dedup,
    lm_score,
    ngram_join,
    periodic,
    ranked_search,
    warc,
)
from sieveline.llm.common import WORD
from sieveline.sizing import staged, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

WORDS_SQL = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLE_SQL[run.__name__] = sql
        return run

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Distinct 5-word shingles of the lower-cased texts; of fewer words, the whole sequence.
SHINGLES_SQL = f"""
w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{dedup.UPPER}', '{dedup.LOWER}'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), g AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)"""

JOIN_SQL = f"""
WITH RECURSIVE {SHINGLES_SQL}, c AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), l AS (
    SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
    WHERE 100 * common >= 75 * (x.n + y.n - common)
), r AS (
    SELECT doc_id, doc_id AS node FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.node = l.a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(node) AS component_id FROM r GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""


@query(JOIN_SQL)
def op1_ngram_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"))


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.fit_on(docs)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "entropy", "rejected")


MIX_SQL = f"""
WITH d AS (
    SELECT doc_id, source, {WORDS_SQL}::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, 'null')) AS k FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        row_number() OVER (ORDER BY source IS NULL, source) - 1 AS i FROM d GROUP BY source
), w AS (SELECT *, (i % 3 + 1)::DOUBLE AS weight, CASE WHEN i % 2 = 0 THEN 1.5 ELSE 0.5 END::DOUBLE AS f FROM s
), lv AS (
    SELECT max(level) AS level FROM (
        SELECT (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER below, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
        FROM w WINDOW below AS (ORDER BY source_size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
), t AS (
    SELECT w.*, least((3 * source_size)::DOUBLE, level * weight) AS target FROM w, lv
), p AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.weight, t.f,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS full_copies
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
    SELECT *, target - full_copies * source_size AS rest FROM p
), m AS (
    SELECT *, (full_copies + CASE WHEN before + size / 2.0::DOUBLE <= rest AND rest > 0 THEN 1 ELSE 0 END)::INT AS copies,
        least((before + size / 2.0::DOUBLE) / target, 1.0) * weight AS demand, weight * f AS w0,
        weight * (2.0 - f) - weight * f AS dw FROM c
)
SELECT doc_id, size, source_size, target, copies, (copies * size)::BIGINT AS taken,
    CASE WHEN copies > 0 AND target > 0 THEN round(CASE WHEN demand = 0 THEN 0.0::DOUBLE ELSE
        least(demand * 2.0 / (w0 + sqrt(greatest(w0 * w0 + dw * demand * 2.0, 0.0))), 1.0) END, 9) END AS position
FROM m
"""


@query(MIX_SQL)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = curriculum.mix_sources(docs)
    first = F.round(F.try_element_at("positions", F.lit(1)), 9)
    return (
        mixed.select("doc_id", "size", "source_size", "target", "copies", F.col("taken").cast("long"), first.alias("position"))
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
    )


# Runs of lines are compared as texts: the shortest ones of 50 words from, and up to, each line.
LINES_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents
), a AS (SELECT doc_id, unnest(s) AS text, generate_subscripts(s, 1) - 1 AS idx FROM d
), b AS (SELECT *, {WORDS_SQL} AS n FROM a
), l AS (SELECT doc_id, idx, text, n, row_number() OVER p AS seq,
    coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c
    FROM b WHERE n > 0 WINDOW p AS (PARTITION BY doc_id ORDER BY idx)
), x AS (
    SELECT doc_id, idx AS first, max(idx) OVER f AS last, max(c + n) OVER f - c AS words, seq AS start,
        string_agg(text, chr(10)) OVER f AS run FROM l
    WINDOW f AS (PARTITION BY doc_id ORDER BY c RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
    UNION ALL
    SELECT doc_id, min(idx) OVER f, idx, c + n - min(c) OVER f, min(seq) OVER f, string_agg(text, chr(10)) OVER f FROM l
    WINDOW f AS (PARTITION BY doc_id ORDER BY c + n RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), y AS (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, start) > 1
        AND (doc_id, start) <> first_value((doc_id, start)) OVER (PARTITION BY run ORDER BY doc_id, start) AS later
    FROM x WHERE words >= 50
), gone AS (
    SELECT DISTINCT b.doc_id, b.idx FROM b JOIN y ON y.doc_id = b.doc_id AND b.idx BETWEEN y.first AND y.last
    WHERE y.later AND b.n > 0
), z AS (
    SELECT b.*, CASE WHEN n > 0 THEN gone.idx IS NOT NULL END AS g
    FROM b LEFT JOIN gone ON gone.doc_id = b.doc_id AND gone.idx = b.idx
), q AS (
    SELECT *, coalesce(g, last_value(g IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx)
        AND first_value(g IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
        false) AS removed FROM z
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS removed_lines,
    sha256(coalesce(string_agg(text, chr(10) ORDER BY idx) FILTER (NOT removed), '')) AS text_sha256
FROM q GROUP BY doc_id
"""


@query(LINES_SQL)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(1)).cast("long"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "removed_lines", F.sha2(text, 256).alias("text_sha256"))


@query()
def op5_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return hash_tree.shard_documents(docs).select(
        "doc_id", "size", "text_crc32", "law", "region", "rack", "shard", "slot", "grown_shard"
    )


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p
), k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keep FROM d)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id < keep THEN keep END AS refers_to
FROM k
"""


@query(WARC_SQL)
def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark)}/archives-{uuid.uuid4().hex}"
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return warc.read_archives(spark, path).select(
        number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )


def escaped_sql(value: str) -> str:
    out = f"replace({value}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHAT_SQL = f"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), r AS (
    SELECT *, role = 'assistant' AS trained,
        {len(chat.BEGIN + chat.SEP + chat.END)} + length({escaped_sql("role")}) + length({escaped_sql("text")}) AS chars,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS is_last
    FROM c
), p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM r)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (trained), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (trained), '')) AS loss_sha256,
    (sum(upto) FILTER (trained OR is_last))::BIGINT AS formatted_chars,
    count(*) FILTER (trained OR is_last) AS n_examples
FROM p GROUP BY conv_id
"""


@query(CHAT_SQL)
def op7_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long"), "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    examples = staged(chat.format_chats(given.unionByName(control)), "chat-examples")
    chats = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
        F.array_sort(
            F.collect_list(
                F.struct("example", chat.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("text"))
            )
        ).alias("loss"),
    )
    turns = chats.withColumns(
        {"turns": chat.read_chat(F.col("longest")), "loss_text": F.concat_ws("", F.transform("loss", lambda x: x["text"]))}
    )
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )


DEDUP_SQL = f"""
WITH d AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), '{dedup.UPPER}', '{dedup.LOWER}')) AS text_sha256 FROM documents
), g AS (
    SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
        row_number() OVER (PARTITION BY text_sha256, doc_id) AS copy FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND copy = 1 AS kept, text_sha256 FROM g
"""


@query(DEDUP_SQL)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(read(spark, sf_dir, "documents"))


SCORES_SQL = """
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w
), u AS (
    SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before, count(*) OVER (PARTITION BY doc_id) AS n,
        count(*) OVER () AS total,
        count(*) OVER (PARTITION BY word) - count(*) OVER (PARTITION BY word, doc_id) AS c1 FROM t
), v AS (
    SELECT *, lag(c1) OVER (PARTITION BY doc_id ORDER BY i) AS c0,
        CASE WHEN before IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY before, word)
            - count(*) OVER (PARTITION BY before, word, doc_id) END AS c2 FROM u
), s AS (
    SELECT doc_id, any_value(n) AS n, sum(CASE WHEN c2 > 0 AND c0 > 0 THEN ln(c2 / c0)
        ELSE ln(greatest(c1, 0.5) / greatest(total - n, 1)) + CASE WHEN i > 1 THEN ln(0.4) ELSE 0 END END) AS log_score
    FROM v GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_words, round(coalesce(s.log_score, 0)::DOUBLE, 4) AS log_score,
    round((s.log_score / s.n)::DOUBLE, 6) AS score_per_word
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id
"""


@query(SCORES_SQL)
def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("score_per_word", 6).alias("score_per_word")
    )


LEAKS_SQL = f"""
WITH {SHINGLES_SQL}, iw AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{dedup.UPPER}', '{dedup.LOWER}'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark
), ig AS (
    SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
    FROM iw WHERE len(w) >= 5
), sets AS (SELECT item_id, string_agg(g, chr(10) ORDER BY g) AS s, count(*) AS m FROM ig GROUP BY item_id
), item AS (SELECT min(item_id) AS item_id, count(*) AS item_copies, any_value(m) AS m FROM sets GROUP BY s
), short AS (SELECT min(item_id) AS item_id, count(*) AS item_copies, ' ' || array_to_string(w, ' ') || ' ' AS s FROM iw
    WHERE len(w) BETWEEN 1 AND 4 GROUP BY w
), dw AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(translate(coalesce(text, ''), '{dedup.UPPER}', '{dedup.LOWER}'),
        '[^\\x20\\x09-\\x0D]+'), ' ') || ' ' AS s FROM documents)
SELECT g.doc_id, item.item_id, item.item_copies, item.m::INT AS item_shingles, count(*) AS shared
FROM g JOIN ig ON ig.g = g.g JOIN item ON item.item_id = ig.item_id
GROUP BY g.doc_id, item.item_id, item.item_copies, item.m HAVING 100 * count(*) >= 75 * item.m
UNION ALL SELECT doc_id, item_id, item_copies, 1, 1 FROM dw JOIN short ON contains(dw.s, short.s)
"""


@query(LEAKS_SQL)
def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


TERMS_SQL = f"""regexp_extract_all(translate(coalesce(text, ''), '{dedup.UPPER}', '{dedup.LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

RANKED_SQL = f"""
WITH d AS (SELECT doc_id, {TERMS_SQL} AS w FROM documents
), n AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0
), c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n
), f AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY doc_id, term
), g AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM f, c GROUP BY term, docs
), q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark) GROUP BY item_id, term
), s AS (
    SELECT item_id, f.doc_id,
        sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
    FROM q JOIN g ON g.term = q.term JOIN f ON f.term = q.term JOIN n ON n.doc_id = f.doc_id, c
    GROUP BY item_id, f.doc_id
), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


@query(RANKED_SQL)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query()
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    # The texts give way to their ids: no text comes back from the tasks' Python.
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, ids="text").withColumnRenamed("text", "ids")
    return bpe.decode(coded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def crc32_sql(value: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    digits = f"list_transform(string_split({value}, ''), lambda d: ascii(d)::BIGINT)"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda r, d: "
        + step.replace("[c,", "[xor(r, d),")
        + "), 4294967295)"
    )


# Every stretch of words that equal those some period before, for every period up to a quarter of the text.
PERIODIC_SQL = f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {crc32_sql("doc_id::VARCHAR")} AS h FROM documents
), e AS (
    SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS planted, len(w)::BIGINT AS n, (h // 10) % greatest(len(w), 1) AS a,
        1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p FROM d
), w AS (
    SELECT doc_id, n, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM e)
), same AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS stretch
    FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), every_period AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY doc_id, q, stretch HAVING count(*) >= 3 * q
), run AS (
    SELECT * FROM every_period r WHERE length >= 6 AND NOT EXISTS (
        SELECT 1 FROM every_period s WHERE s.doc_id = r.doc_id AND s.q < r.q AND r.q % s.q = 0
            AND s.start <= r.start AND s.start + s.length >= r.start + r.length)
), best AS (
    SELECT doc_id, count(*) AS n_runs, first(start ORDER BY length DESC, start, q) AS start,
        max(length) AS length, first(q ORDER BY length DESC, start, q) AS period,
        string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed FROM run GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM w
    WHERE NOT EXISTS (SELECT 1 FROM run r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.q AND w.i < r.start + r.length)
    GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
    (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
    sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


def with_repetitions(docs: DataFrame) -> DataFrame:
    """The texts of about a tenth of the documents, chosen by id, with their words repeated from some place on."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n, a, p = F.col("__n"), F.col("__a"), F.col("__p")
    hashed = docs.withColumn("__h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    parted = hashed.withColumn("__w", F.when(F.col("__h") % 10 == 0, words))
    placed = parted.withColumns({"__n": F.size("__w"), "__g": F.floor(F.col("__h") / 10)})
    placed = placed.withColumn("__a", F.when(n > 0, F.col("__g") % n).cast("int"))
    placed = placed.withColumn("__p", (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("__g") % 8))).cast("int"))
    block = F.slice("__w", a + 1, p)
    copies = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
    repeated = F.concat(F.slice("__w", F.lit(1), a), F.slice(copies, F.lit(1), n - a))
    return placed.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query(PERIODIC_SQL)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_repetitions(read(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    shown = found.withColumns({"__best": best, "__listed": F.array_join(listed, "")})
    start, length, period = -F.col("__best.s"), F.col("__best.n"), -F.col("__best.p")
    return shown.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(F.lit(1000) * length / period).alias("exponent_milli"),
        F.sha2(F.col("__listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
