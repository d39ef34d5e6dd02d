"""Exact dedup: two-pass Bloom filtering, so that only possibly repeated texts are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.llm.common import join_groups
from sieveline.sizing import staged

BITS_PER_ROW = 16
PROBES = 3
# A block of the filter: 64 words of 64 bits. A row's probes all fall into one block.
BLOCK_BITS = 4096
# Largest filter that is broadcast: 32 MiB of bits.
MAX_BLOCKS = (32 << 23) // BLOCK_BITS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: str | Column) -> Column:
    """A-Z lower-cased and nothing else. A text of ASCII alone takes the faster function."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fingerprints(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    digest = F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))).cast("binary"), 256)
    return docs.select(F.col(doc_id).alias("doc_id"), digest.alias("text_sha256"))


def probe(blocks: int) -> dict[str, Column]:
    """Block and bits of a fingerprint in a filter of ``blocks`` blocks."""
    bits = F.xxhash64("text_sha256", F.lit(1))
    return {
        "__block": F.pmod(F.xxhash64("text_sha256"), F.lit(blocks)),
        "__bits": F.array(*[F.shiftrightunsigned(bits, 12 * k).bitwiseAND(BLOCK_BITS - 1) for k in range(PROBES)]),
    }


def repeat_filter(rows: DataFrame, blocks: int) -> DataFrame:
    """First pass: (block, 64 words) of the bits that at least two rows set.

    Bits are counted before they are shuffled, so a text with many copies is no hot spot.
    """
    bits = rows.select(*[c.alias(name) for name, c in probe(blocks).items()])
    bits = bits.select("__block", F.explode("__bits").alias("bit")).groupBy("__block", "bit").count()
    twice = bits.filter("count > 1")
    words = twice.groupBy("__block", F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("bits")
    )
    filled = words.groupBy("__block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("set"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.col("set")[i.cast("long")], F.lit(0)))
    return filled.select("__block", dense.alias("__words"))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest ``doc_id`` stays (null is the smallest). Rows that repeat
    a ``doc_id`` with an equal text are copies too: one of them stays. An empty table gives an
    empty result; other columns of ``docs``, whatever their names, are not read.

    Pass 1 sets bits of each text's fingerprint and keeps those that two rows set. Pass 2 tests
    every row against them: a row with an unset bit is the only one of its text and passes
    straight through. The others, the repeated and a few by chance, are shuffled and grouped
    exactly. The filter is broadcast and takes at most 32 MiB; with more than 16 million rows it
    passes on more rows by chance, which are grouped exactly like the others.
    """
    rows = staged(fingerprints(docs, doc_id, text), "exact-dedup")
    total = rows.count()
    blocks = min(max(1, -(-total * BITS_PER_ROW // BLOCK_BITS)), MAX_BLOCKS)
    seen = rows.withColumns(probe(blocks)).join(F.broadcast(repeat_filter(rows, blocks)), "__block", "left")
    is_set = lambda b: F.expr("true") & (
        F.col("__words")[F.shiftright(b, 6).cast("int")].bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(63).cast("int"))) != 0
    )
    repeated = F.coalesce(F.forall("__bits", is_set), F.lit(False))
    seen = seen.withColumn("__repeated", F.col("__words").isNotNull() & repeated)
    single = seen.filter("not __repeated").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    members = seen.filter("__repeated").groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    groups = members.groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count(F.lit(1)).alias("ids")
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return single.unionByName(
        join_groups(members, groups, "text_sha256", "ids", total)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("doc_id", "keep_id", "group_size", (stays & (F.col("copy") == 1)).alias("kept"), "text_sha256")
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; rows of one ``doc_id`` stay or go together."""
    gone = exact_dedup(docs, doc_id, text).groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("not kept")
    return docs.join(gone, docs[doc_id].eqNullSafe(gone["doc_id"]), "left_anti")
