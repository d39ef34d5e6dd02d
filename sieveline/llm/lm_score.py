"""LM scoring by stupid backoff over the corpus's own n-gram counts.

Count tables and texts are too large to send to every task, so the two are joined by hash. Texts
are dealt into chunks of some million words. Each chunk's distinct n-grams, with their counts in
the chunk, go to the part of the count table that their hash names; a part adds up what all
chunks say and answers each chunk with the counts of its n-grams. The n-grams of a pair of
chunk and part travel as one block of sorted hashes, so a frequent n-gram is one entry per
chunk, never one per occurrence.

A document is scored against the rest of the corpus: its own occurrences are taken off the counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sieveline.llm.common import word_count
from sieveline.llm.words import grams, texts_of_words

ORDER = 2
BACKOFF = 0.4
# Characters of one chunk, and n-grams of one part of the count table, about.
CHUNK_CHARS = 6 << 20
PART_GRAMS = 2 << 20


def chunk_counts(docs: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all orders in a chunk, sorted, and their counts."""
    found = [grams(w, k) for w in docs for k in range(1, order + 1) if len(w) >= k]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(np.concatenate(found), return_counts=True)


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane, which compresses well."""
    return np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of the count table that holds a key: equal ranges of hashes, in their order."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def score(words: np.ndarray, keys: np.ndarray, counts: np.ndarray, total: int, order: int) -> float:
    """Sum over the words of log S(word | words before), with the document's own counts taken off.

    S is c(context word) / c(context) if the n-gram occurs in the rest of the corpus, else BACKOFF
    times S with the context shortened; the last step is c(word) / total, where a word that no
    other document has counts as half an occurrence.
    """
    left = []
    for k in range(1, order + 1):
        g = grams(words, k) if len(words) >= k else np.zeros(0, np.uint64)
        own, where, times = np.unique(g, return_inverse=True, return_counts=True)
        rest = counts[np.searchsorted(keys, own)] - times
        left.append((rest[where], g))
    n = len(words)
    rest_total = max(total - n, 1)
    value = np.log(np.maximum(left[0][0], 0.5) / rest_total)
    for k in range(2, order + 1):
        if n < k:
            break
        # The context's count is that of the n-gram one shorter, one place before.
        context = left[k - 2][0][: n - k + 1]
        here = left[k - 1][0]
        seen = (here > 0) & (context > 0)
        longer = np.log(np.where(seen, here, 1) / np.where(seen, context, 1))
        value[k - 1 :] = np.where(seen, longer, np.log(BACKOFF) + value[k - 1 :])
    return float(value.sum())


def lm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """One row per document: ``doc_id, n_words, log_score, score_per_word``.

    ``log_score`` is the natural logarithm of the text's stupid-backoff score under an n-gram model
    of all other rows, ``score_per_word`` that per word. Null and empty texts have no words, a log
    score of 0 and no score per word. Copies are rows like others: a text with a copy elsewhere
    scores high. Rows that repeat an id are scored one by one. An empty table gives no rows;
    other columns are not read, whatever their names.
    """
    id_type = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    size, many, total = rows.agg(F.sum(F.length("text")), F.count(F.lit(1)), F.sum(word_count("text"))).first()
    chunks = max(1, -(-(size or 0) // CHUNK_CHARS), -(-(many or 0) // 100_000))
    # About one word for six characters, and fewer new n-grams than words for each order.
    parts = max(12, -(-(size or 0) * order // 6 // PART_GRAMS))
    # Rows are dealt by id and size, so that rows that share an id do not all meet.
    key = F.pmod(F.xxhash64("doc_id", F.length("text"), F.crc32(F.col("text").cast("binary"))), F.lit(chunks))
    dealt = rows.withColumn("chunk", key.cast("int"))

    def words_of(pdf: pd.DataFrame) -> list[np.ndarray]:
        batch = pa.RecordBatch.from_arrays([pa.array(pdf["text"], pa.large_string())], ["text"])
        return [w for _, run in texts_of_words(iter([batch]), "text") for w in run]

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        docs_words = words_of(pdf)
        keys, counts = chunk_counts(docs_words, order)
        bounds = np.searchsorted(part_of(keys, parts), np.arange(parts + 1, dtype=np.uint64))
        out = [
            (g, packed(keys[a:b]), counts[a:b].astype(np.int32).tobytes())
            for g, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))
            if a < b
        ]
        return pd.DataFrame(out, columns=["part", "keys", "counts"]).assign(chunk=pdf["chunk"].iloc[0])

    asked = dealt.groupBy("chunk").applyInPandas(ask, "chunk int, part int, keys binary, counts binary")

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [unpacked(k) for k in pdf["keys"]]
        names, where = np.unique(np.concatenate(keys), return_inverse=True)
        given = np.concatenate([np.frombuffer(c, np.int32) for c in pdf["counts"]])
        sums = np.bincount(where, weights=given).astype(np.int64)[where]
        ends = np.cumsum([len(k) for k in keys])
        told = [s.tobytes() for s in np.split(sums, ends[:-1])]
        return pd.DataFrame({"chunk": pdf["chunk"], "part": pdf["part"], "counts": told})

    # The texts are shuffled once: both sides of the last step share that exchange.
    answered = asked.groupBy("part").applyInPandas(answer, "chunk int, part int, counts binary")
    total = total or 0

    def score_chunk(pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        docs_words = words_of(pdf)
        keys, _ = chunk_counts(docs_words, order)
        # Answers come in the order of the questions, so part after part in the order of the keys.
        told = told.sort_values("part")["counts"]
        counts = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(c, np.int64) for c in told]])
        n = np.array([len(w) for w in docs_words], np.int64)
        logs = np.array([score(w, keys, counts, total, order) if len(w) else 0.0 for w in docs_words])
        per_word = [x / k if k else None for x, k in zip(logs, n)]
        return pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": n, "log_score": logs, "score_per_word": pd.array(per_word, "Float64")})

    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("n_words", T.LongType()),
            T.StructField("log_score", T.DoubleType()),
            T.StructField("score_per_word", T.DoubleType()),
        ]
    )
    return dealt.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInPandas(score_chunk, schema)
