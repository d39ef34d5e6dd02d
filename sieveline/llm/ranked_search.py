"""Ranked lexical search: the highest inner products of item and document vectors, by norm buckets.

A document's vector holds the impacts of the terms that some item has, an item's the terms' weights
times their numbers. Documents are ordered by the length of their vectors and searched from the
longest on, in buckets. The k-th best score of an item so far is its threshold: by the
Cauchy-Schwarz inequality, a bucket whose longest vector times the item's stays below it holds no
better document, nor does the rest of a bucket from the first such vector on. Inside, the item's
heaviest coordinates are chosen so that the others, bounded by lengths and by the bucket's largest
impact of each term, cannot reach the threshold by themselves: only documents with one of the chosen
terms are looked at, and of those only the ones whose partial sum and bound for the rest reach the
threshold are scored, exactly, in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from sieveline.llm.spans import ALPHANUMERIC, LOWER, buffers, runs_of_rows, span_hashes, word_spans
from sieveline.sizing import measured_bytes, staged

PIECE_BYTES = 4 << 20
# Items are searched for in blocks of about this size, which go through the driver to the executors.
BLOCK_BYTES = 16 << 20
# Shares of the documents, by descending length, after which thresholds are exchanged.
ROUNDS = (1 / 64, 1 / 8)
# Documents of one bucket.
BUCKET = 4096
# Floating-point bounds are widened by this much; scores are integers.
SLACK = 1 + 1e-9


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of all terms, by text and term, and the number of terms of each text.

    A term is a run of ASCII letters and digits and of other characters, its letters A-Z lower-cased; given by its hash.
    """
    data, offsets = buffers(texts)
    starts, ends, at = word_spans(data, offsets, ALPHANUMERIC)
    terms = span_hashes(data, starts, ends, LOWER)
    n = np.diff(at)
    text = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((terms, text))
    text, terms = text[order], terms[order]
    heads = np.flatnonzero(np.concatenate([[True], (np.diff(text) != 0) | (terms[1:] != terms[:-1])])[: len(terms)])
    return text[heads], terms[heads], np.diff(np.concatenate([heads, [len(terms)]])), n


def lists(values: np.ndarray, owners: np.ndarray, size: int, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owners, np.arange(size + 1)), pa.int32()), pa.array(values, kind))


def item_vectors(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, terms, counts): the terms of each distinct item that has any."""
    schema = T.StructType(
        [T.StructField("item_id", items.schema[item_id].dataType), T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType())]
    )

    def vectors(batches):
        for batch in batches:
            for piece in runs_of_rows(batch, "text", PIECE_BYTES):
                owner, terms, counts, n = term_counts(piece.column("text"))
                bounds = np.searchsorted(owner, np.arange(len(n) + 1))
                spans = [(a, b) for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
                columns = [[x[a:b].tobytes() for a, b in spans] for x in (terms, counts.astype(np.int64))]
                ids = piece.column("item_id").filter(pa.array(n > 0))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.binary()) for c in columns]], schema.names)

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(vectors, schema).distinct()


def document_terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts) of every document: of the terms in ``vocabulary`` their numbers and occurrences."""
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
        ]
    )

    def terms_of(batches):
        for batch in batches:
            for piece in runs_of_rows(batch, "text", PIECE_BYTES):
                owner, terms, counts, n = term_counts(piece.column("text"))
                at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
                known = vocabulary[at] == terms
                owner, at, counts = owner[known], at[known], counts[known]
                columns = [pa.array(n, pa.int64()), lists(at, owner, len(n), pa.int32()), lists(counts, owner, len(n), pa.int32())]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], schema.names)

    return docs.mapInArrow(terms_of, schema)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the offsets of its rows."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


def impact_vectors(rows: DataFrame, weights: np.ndarray, documents: int, terms_in_all: int) -> DataFrame:
    """(doc_id, length, terms, impacts): the documents with a weighted term, each task's longest vectors first.

    Coordinates are multiplied by the roots of the terms' weights, here and in the items.
    """
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("length", T.DoubleType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("impacts", T.ArrayType(T.LongType())),
        ]
    )

    def vectors(batches):
        for batch in batches:
            terms, bounds = flat(batch.column("terms"))
            counts = flat(batch.column("counts"))[0].astype(np.int64)
            n = batch.column("n").to_numpy()
            owner = np.repeat(np.arange(len(n)), np.diff(bounds))
            m = 100 - 75 + (75 * n * documents) // terms_in_all
            impacts = (1_000_000_000 * counts) // (1000 * counts + 8 * m[owner])
            squares = np.bincount(owner, weights[terms] * impacts.astype(float) ** 2, len(n))
            keep = squares > 0
            kept = keep[owner]
            place = np.cumsum(keep) - 1
            size = int(keep.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").filter(pa.array(keep)),
                    pa.array(np.sqrt(squares[keep])),
                    lists(terms[kept], place[owner[kept]], size, pa.int32()),
                    lists(impacts[kept], place[owner[kept]], size, pa.int64()),
                ],
                schema.names,
            )

    return rows.mapInArrow(vectors, schema).sortWithinPartitions(F.desc("length"))


class Query:
    """An item: its terms by descending coordinate, their weights, and the lengths of what is left of it."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray):
        heaviest = np.argsort(-(counts * np.sqrt(weights[terms])), kind="stable")
        self.terms = terms[heaviest]
        self.weights = counts[heaviest] * weights[self.terms]
        squares = (counts[heaviest].astype(float) ** 2) * weights[self.terms]
        # rest[i]: length of the item without its first i coordinates.
        self.rest = np.sqrt(np.concatenate([np.cumsum(squares[::-1])[::-1], [0.0]]))


class Bucket:
    """Documents by descending length, with the postings of each term."""

    def __init__(self, ids: pa.Array, lengths: np.ndarray, terms: np.ndarray, impacts: np.ndarray, bounds: np.ndarray, size: int):
        self.ids, self.lengths, self.terms, self.impacts, self.bounds = ids, lengths, terms, impacts, bounds
        owner = np.repeat(np.arange(len(lengths)), np.diff(bounds))
        order = np.argsort(terms, kind="stable")
        self.owner, self.posted = owner[order], impacts[order].astype(float)
        self.at = np.searchsorted(terms[order], np.arange(size + 1))
        self.most = np.zeros(size)
        held = np.flatnonzero(np.diff(self.at))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.posted, self.at[held])

    def survivors(self, query: Query, threshold: int) -> np.ndarray:
        """Documents whose bound reaches the threshold."""
        if self.lengths[0] * query.rest[0] * SLACK < threshold:
            return np.zeros(0, np.int64)
        long = int(np.searchsorted(-self.lengths, -threshold / (query.rest[0] * SLACK), "right"))
        most = query.weights * self.most[query.terms]
        left = np.concatenate([np.cumsum(most[::-1])[::-1], [0.0]])
        bound = np.minimum(query.rest * self.lengths[0], left)
        focus = max(1, int(np.argmax(bound * SLACK < threshold))) if (bound * SLACK < threshold).any() else len(query.terms)
        spans = [(t, self.at[t], self.at[t + 1]) for t in query.terms[:focus]]
        found = [self.owner[a:b] for _, a, b in spans]
        values = [self.posted[a:b] * w for (_, a, b), w in zip(spans, query.weights)]
        partial = np.bincount(np.concatenate(found), np.concatenate(values), len(self.lengths))[:long]
        rest = np.minimum(query.rest[focus] * self.lengths[:long], left[focus])
        return np.flatnonzero((partial > 0) & ((partial + rest) * SLACK >= threshold))

    def scores(self, docs: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores; ``dense`` has an item's weight of every term."""
        n = self.bounds[docs + 1] - self.bounds[docs]
        heads = np.cumsum(n) - n
        places = np.arange(int(n.sum())) + np.repeat(self.bounds[docs] - heads, n)
        return np.add.reduceat(dense[self.terms[places]] * self.impacts[places], heads)


def best(found: list[tuple], k: int) -> list[tuple]:
    """The k best of (score, id): higher scores, then smaller ids, null last."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:k]


def search_vectors(vectors: DataFrame, queries: list[Query], thresholds: list[int], vocabulary: int, k: int) -> DataFrame:
    """(item, doc_id, score): of each task, at most its k best documents of every item that reach the threshold."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), vectors.schema["doc_id"], T.StructField("score", T.LongType())])
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def search(batches):
        top: list[list[tuple]] = [[] for _ in queries]
        least = list(thresholds)
        dense = np.zeros(vocabulary, np.int64)
        for batch in batches:
            # A task reads several files, or pieces of them, of which only each by itself is in order.
            lengths = batch.column("length").to_numpy()
            if (lengths[1:] > lengths[:-1]).any():
                batch = batch.take(pa.array(np.argsort(-lengths, kind="stable")))
            for at in range(0, len(batch), BUCKET):
                part = batch.slice(at, BUCKET)
                terms, bounds = flat(part.column("terms"))
                impacts = flat(part.column("impacts"))[0]
                bucket = Bucket(part.column("doc_id"), part.column("length").to_numpy(), terms, impacts, bounds, vocabulary)
                for i, query in enumerate(queries):
                    docs = bucket.survivors(query, least[i])
                    if not len(docs):
                        continue
                    dense[query.terms] = query.weights
                    scores = bucket.scores(docs, dense)
                    dense[query.terms] = 0
                    cut = max(least[i], np.partition(scores, -k)[-k] if len(scores) > k else 0)
                    good = scores >= cut
                    ids = bucket.ids.take(pa.array(docs[good])).to_pylist()
                    top[i] = best(top[i] + list(zip(scores[good].tolist(), ids)), k)
                    if len(top[i]) == k:
                        least[i] = max(least[i], top[i][-1][0])
        rows = [(i, d, s) for i, found in enumerate(top) for s, d in found if s > 0]
        columns = list(zip(*rows)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], schema.names)

    return vectors.mapInArrow(search, schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The rows of the k best of each item, with ``rank``."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(docs: DataFrame, block: list, k: int) -> DataFrame:
    """(item, rank, doc_id, score) for one block of items; ``item`` is the place in the block."""
    hashes = [np.frombuffer(r["terms"], np.uint64) for r in block]
    vocabulary = np.unique(np.concatenate(hashes))
    rows = staged(document_terms(docs, vocabulary), "document-terms")
    documents, in_all = rows.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").count()
    weight = F.floor(F.lit(1000) * F.log(F.lit(2 * documents + 2) / (F.lit(2) * F.col("count") + F.lit(1))))
    weights = np.zeros(len(vocabulary), np.int64)
    for r in held.select("term", weight.cast("long").alias("weight")).collect():  # as many rows as the block has terms
        weights[r["term"]] = r["weight"]
    queries = [
        Query(np.searchsorted(vocabulary, h), np.frombuffer(r["counts"], np.int64), weights) for h, r in zip(hashes, block)
    ]
    vectors = staged(impact_vectors(rows, weights, documents, max(1, in_all)), "impact-vectors")
    edges = vectors.agg(F.percentile_approx("length", F.array(*[F.lit(1 - x) for x in ROUNDS]), F.lit(10_000))).first()[0]
    found, thresholds, above = None, [1] * len(queries), None
    for edge in [*(edges or []), None]:
        part = vectors if above is None else vectors.filter(F.col("length") < above)
        part = part if edge is None else part.filter(F.col("length") >= edge)
        here = search_vectors(part, queries, thresholds, len(vocabulary), k)
        found = staged(ranked(here if found is None else found.unionByName(here), k).drop("rank"), "ranked")
        above = edge
        # As many rows as the block has items.
        for r in found.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).collect():
            if r["n"] == k:
                thresholds[r["item"]] = r["least"]
    return ranked(found, k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 for every item.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased, compared by
    64-bit hashes. With N documents that have a term, L terms in all, n in a document, and df documents
    that hold a term, its weight is floor(1000 ln((2N + 2) / (2 df + 1))), and the score sums, over the
    item's terms with repeats, weight * (10^9 tf div (1000 tf + 8m)), where m = 25 + (75 n N) div L.
    Equal scores are ranked by the smaller id, null last.

    Null and empty texts have no term: such items and documents are in no result. Rows of the items
    that are equal in id and terms are one item; rows with one id and other terms are ranked apart.
    Repeated document rows are ranked each. Empty tables give no rows. Other columns are not read,
    whatever their names. Items go to the executors in blocks of about ``block_bytes``, one search of
    the documents per block; documents are not shuffled. ``doc_id`` is any type that can be ordered.
    """
    vectors = staged(item_vectors(items, item_id, item_text), "item-vectors")
    blocks = max(1, -(-measured_bytes(vectors) // block_bytes))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    spark = docs.sparkSession
    names_schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", items.schema[item_id].dataType)])
    result = spark.createDataFrame(
        [], T.StructType([names_schema["item_id"], T.StructField("rank", T.IntegerType()), rows.schema["doc_id"], T.StructField("score", T.LongType())])
    )
    for b in range(blocks):
        block = vectors.filter(F.pmod(F.xxhash64("terms", "counts"), F.lit(blocks)) == b).collect()
        if not block:
            continue
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], names_schema)
        found = search_block(rows, block, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        result = result.unionByName(found)
    return result
