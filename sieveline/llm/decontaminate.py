"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so the Jaccard similarity of the two says little. Items
are therefore partitioned by size, and for each size class a document is read in windows of
twice the class's size, each overlapping the next by half: within a window, an item that the
document contains has a large similarity. Item and window are compared by one-permutation
MinHash: the hash space is cut into bins, and a signature is the least shingle hash of each bin.
A window that shares a signature value with an item makes document and item a candidate pair,
which is verified by exact containment over the whole document. Items of fewer than five words are
one shingle, the whole sequence, and are looked up by it.

With 64 bins, a window of the largest ratio (four times the item's shingles) that holds 75 % of an item
shares no signature value with it in about 4 of a million cases: each bin agrees with the Jaccard
similarity, 0.18, as its chance. An item whose parts lie far apart is searched for by each part. Items of
at most 8 shingles are candidates by any of these.

A window's signature is only worked out around the shingles that some item has in its own
signature, as no other value can agree; the candidates are those of the full signatures.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sieveline.llm.common import join_groups
from sieveline.llm.words import grams, shingles, texts_of_words
from sieveline.sizing import broadcast_if_small, measured_bytes, small_batches, staged

SHINGLE_WORDS = 5
PERCENT = 75
BIN_BITS = 6
# Items of at most so many shingles are candidates by any of them: of so few, bins might hide all.
SMALL_SET = 8
# Items are sent to the executors in blocks of about this size.
BLOCK_BYTES = 16 << 20


class Items:
    """A block of test items, (id, words of a shingle, shingles), ready for search: sets of shingles,
    the signature of each class, and the short items by their number of words."""

    def __init__(self, rows: list[tuple]):
        self.sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        keys, owners, widths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        short: dict[int, list[int]] = {}
        for i, (s, (_, size, _)) in enumerate(zip(self.sets, rows)):
            if size < SHINGLE_WORDS:
                short.setdefault(size, []).append(i)
                continue
            bins = s >> np.uint64(64 - BIN_BITS)
            least = s if len(s) <= SMALL_SET else s[np.concatenate([[True], bins[1:] != bins[:-1]])]  # sets are sorted
            keys.append(least)
            owners.append(np.full(len(least), i))
            widths.append(np.full(len(least), 1 << (len(s) - 1).bit_length()))
        keys, owners, widths = map(np.concatenate, (keys, owners, widths))
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners, self.widths = keys[order], owners[order], widths[order]
        self.short = {k: (np.array(at), np.concatenate([self.sets[i] for i in at])) for k, at in sorted(short.items())}

    def found_in(self, words: np.ndarray, percent: int) -> list[tuple[int, int]]:
        """(item, shingles shared) of the items that a document of these words contains."""
        found = []
        for size, (items, keys) in self.short.items():
            if len(words) >= size:
                found += [(int(i), 1) for i in items[np.isin(keys, grams(words, size))]]
        if len(self.keys) and len(words) >= SHINGLE_WORDS:
            h = shingles(words, SHINGLE_WORDS)
            for i in sorted(self.candidates(h)):
                common = int(np.isin(self.sets[i], h).sum())
                if common * 100 >= percent * len(self.sets[i]):
                    found.append((i, common))
        return found

    def candidates(self, h: np.ndarray) -> set[int]:
        """Items of which a window of the shingles ``h`` shares a signature value."""
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        found: set[int] = set()
        for place in np.flatnonzero(self.keys[at] == h):
            k = at[place]
            while k < len(self.keys) and self.keys[k] == h[place]:
                if self.owners[k] not in found and (self.widths[k] <= SMALL_SET or self.least_in_window(h, int(place), int(self.widths[k]))):
                    found.add(int(self.owners[k]))
                k += 1
        return found

    @staticmethod
    def least_in_window(h: np.ndarray, place: int, width: int) -> bool:
        """Whether a shingle is the least of its bin in one of the two windows that hold it."""
        block = place // width
        shift = np.uint64(64 - BIN_BITS)
        for first in (block - 1, block):
            window = h[max(0, first * width) : (first + 2) * width]
            if window[(window >> shift) == (h[place] >> shift)].min() == h[place]:
                return True
        return False


def shingled(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, size, shingles) of each item with words: its set, sorted, of shingles of ``size`` words."""
    schema = T.StructType(
        [
            T.StructField("item_id", items.schema[item_id].dataType),
            T.StructField("size", T.IntegerType()),
            T.StructField("shingles", T.BinaryType()),
        ]
    )

    def sets(batches):
        for run, words in texts_of_words(batches, "text"):
            keep = [i for i, w in enumerate(words) if len(w)]
            sizes = [min(len(words[i]), SHINGLE_WORDS) for i in keep]
            blobs = [np.unique(shingles(words[i], SHINGLE_WORDS)).tobytes() for i in keep]
            ids = run.column("item_id").take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int32()), pa.array(blobs, pa.binary())], schema.names)

    return items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).mapInArrow(sets, schema)


def item_sets(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(size, shingles, item_id, item_copies): one row per distinct set, with its smallest id."""
    rows = shingled(items, item_id, text)
    return rows.groupBy("size", "shingles").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("item_copies"))


def item_members(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, member_id``: the items that ``find_leaks`` reports under ``item_id``, itself included.

    Items without words are in no row, rows that repeat an id count once each.
    """
    rows = staged(
        shingled(items, item_id, text).select(F.col("item_id").alias("member_id"), F.sha2(F.concat(F.col("size").cast("string"), F.lit(":"), F.hex("shingles")).cast("binary"), 256).alias("set")),
        "item-members",
    )
    groups = rows.groupBy("set").agg(F.min("member_id").alias("item_id"), F.count(F.lit(1)).alias("members"))
    return join_groups(rows, groups, "set", "members", rows.count()).select("item_id", "member_id")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, item_id, item_copies, item_shingles, shared``: documents that contain an item.

    A document contains an item when it has at least ``percent`` of the item's distinct 5-word
    shingles, anywhere in its text; an item of one to four words is one shingle, the whole sequence.
    Items with equal shingles are one, under the smallest id (``item_copies`` counts them,
    ``item_members`` names them). Null and empty items and texts have no shingle: they contain nothing
    and are contained in nothing. Repeated document rows are each reported. Empty tables give no
    rows. Other columns are not read, whatever their names.

    Items are sent to the executors in blocks of bounded size, one pass over the documents per
    block; no document is shuffled.
    """
    small_batches(docs.sparkSession)
    sets = staged(item_sets(items, item_id, item_text), "item-sets")
    blocks = -(-measured_bytes(sets) // BLOCK_BYTES)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("item", T.IntegerType()),
            T.StructField("shared", T.LongType()),
        ]
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    result = None
    for b in range(max(1, blocks)):
        block = sets.filter(F.pmod(F.xxhash64("shingles"), F.lit(max(1, blocks))) == b).orderBy("item_id").toArrow()
        blobs = block["shingles"].to_pylist()
        sent = list(zip(range(len(blobs)), block["size"].to_pylist(), blobs))
        # As an Arrow table: rows of Python objects would be read by Python workers of their own.
        names = docs.sparkSession.createDataFrame(
            pa.table(
                {
                    "item": pa.array(range(len(blobs)), pa.int32()),
                    "item_id": block["item_id"],
                    "item_copies": block["item_copies"],
                    "item_shingles": pa.array([len(s) // 8 for s in blobs], pa.int32()),
                }
            ),
            T.StructType(
                [
                    T.StructField("item", T.IntegerType()),
                    T.StructField("item_id", items.schema[item_id].dataType),
                    T.StructField("item_copies", T.LongType()),
                    T.StructField("item_shingles", T.IntegerType()),
                ]
            ),
        )

        def search(batches, sent=sent):
            index = Items(sent) if sent else None
            for run, words in texts_of_words(batches, "text"):
                docs_at, found, shared = [], [], []
                for i, w in enumerate(words if index else []):
                    for k, common in index.found_in(w, percent):
                        docs_at.append(i)
                        found.append(k)
                        shared.append(common)
                ids = run.column("doc_id").take(pa.array(docs_at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(found, pa.int32()), pa.array(shared, pa.int64())], ["doc_id", "item", "shared"]
                )

        leaks = rows.mapInArrow(search, schema).join(F.broadcast(names), "item")
        result = leaks if result is None else result.unionByName(leaks)
    return result.select("doc_id", "item_id", "item_copies", "item_shingles", "shared")


def decontaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents, with all their columns, that contain no item; a null id stays only if no
    document with a null id contains one."""
    leaks = staged(find_leaks(docs, items, doc_id, **options).select(F.col("doc_id").alias("__leak")).distinct(), "leaks")
    return docs.join(broadcast_if_small(leaks), docs[doc_id].eqNullSafe(F.col("__leak")), "left_anti")
