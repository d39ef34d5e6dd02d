"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

Two sets of sizes m and n with a Jaccard similarity of at least t share at least
a = ceil(t (m + n) / (1 + t)) elements. When both are sorted by one global order, rarest first,
they must share an element among their first n - ceil(t n) + 1: the prefixes. Only prefixes are
shuffled; documents that meet there are candidates, are filtered, and are compared once.

The order goes by frequency, then by hash. Frequencies come from a count sketch of 2**20 counters
over all documents. Their counts are compared as they are: what else falls into a counter varies by
the root of the mean count only, so the more documents there are, the rarer are the elements that
still come late. Any order gives the same links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sieveline.llm.common import HOT_ROWS, join_groups
from sieveline.llm.components import components, forest
from sieveline.llm.words import mixed, shingles, texts_of_words
from sieveline.sizing import broadcast_if_small, small_batches, staged

SHINGLE_WORDS = 5
PERCENT = 75

SKETCH_BITS = 20
SKETCH_BLOCK = 1 << 16
# Prefix elements per shuffle group, and words of pairs per verifying group.
GROUP_TOKENS = 1 << 20
GROUP_WORDS = 8 << 20
# Rows of clusters per group.
GROUP_ROWS = 20_000
# Documents of a block that all others are compared with at first.
PIVOTS = 16
# Members of a cluster that one task compares with as many others.
BLOCK_MEMBERS = 2000
# Pairs of one cluster that are verified together.
CLUSTER_PAIRS = 2000
SUFFIX_RANGES = 128
# Documents that share an element and are tried pair by pair before they are sent on.
RUN_MEMBERS = 64
# Different counts that the order of elements tells apart.
RANKS = 1 << 16


def range_counts(u: np.ndarray, ranges: int) -> bytes:
    """Elements in each of a power of two of hash ranges, two counts a byte; counts end at 15, which only
    weakens filters."""
    counts = np.bincount((u >> np.uint64(40)).astype(np.int64) % ranges, minlength=ranges)
    counts = np.minimum(counts, 15).astype(np.uint8)
    return (counts[0::2] | counts[1::2] << 4).tobytes()


def counts_of(packed: bytes) -> np.ndarray:
    both = np.frombuffer(packed, np.uint8)
    return np.stack([both & 15, both >> 4], axis=1).reshape(-1).astype(np.int16)


def fine_counts(u: np.ndarray) -> bytes:
    """Counts in ranges of one or two elements, for sets that fill :data:`SUFFIX_RANGES` too densely; else nothing."""
    return b"" if len(u) <= 2 * SUFFIX_RANGES else range_counts(u, 1 << (len(u) - 1).bit_length() - 1)


def fine_distance(x: bytes, y: bytes) -> int:
    """Least symmetric difference of two sets, by their fine counts. The ranges of the coarser one
    are unions of those of the finer one."""
    a, b = sorted((counts_of(x), counts_of(y)), key=len)
    return int(np.abs(a - b.reshape(-1, len(a)).sum(axis=0)).sum()) if len(a) else 0


def set_key(u: np.ndarray) -> bytes:
    """128-bit fingerprint of a set of hashes."""
    other = mixed(u ^ np.uint64(0x5851F42D4C957F2D))
    return int(np.add.reduce(mixed(u))).to_bytes(8, "big") + int(np.add.reduce(other)).to_bytes(8, "big")


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def least_overlap(m: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection i with 100 i >= percent (m + n - i)."""
    return -(-(percent * (m + n)) // (100 + percent))


def measured_sets(docs: DataFrame) -> DataFrame:
    """First pass, staged: a row per document (``id, hash, n, key, ranges, fine``) and sketch rows (``block, counts``)."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema["id"].dataType),
            T.StructField("hash", T.LongType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("ranges", T.BinaryType()),
            T.StructField("fine", T.BinaryType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("counts", T.BinaryType()),
        ]
    )
    names = schema.names
    id_type = docs.schema["id"].dataType

    def measure(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for run, words in texts_of_words(batches, "text"):
            n, key, ranges, fine, all_ = [], [], [], [], []
            for w in words:
                u = np.unique(shingles(w, SHINGLE_WORDS))
                n.append(len(u))
                key.append(set_key(u) if len(u) else None)
                ranges.append(range_counts(u, SUFFIX_RANGES))
                fine.append(fine_counts(u))
                all_.append(u)
            slots = (np.concatenate(all_) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
            sketch += np.bincount(slots, minlength=len(sketch)).astype(np.uint32)
            none = pa.nulls(len(n), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [run.column("id"), run.column("hash"), pa.array(n, pa.int32()), pa.array(key, pa.binary()), pa.array(ranges, pa.binary()), pa.array(fine, pa.binary()), none, pa.nulls(len(n), pa.binary())],
                names,
            )
        blocks = [sketch[i : i + SKETCH_BLOCK].tobytes() for i in range(0, len(sketch), SKETCH_BLOCK)]
        k = len(blocks)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, to_arrow_type(id_type)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), *[pa.nulls(k, pa.binary())] * 3, pa.array(range(k), pa.int32()), pa.array(blocks, pa.binary())],
            names,
        )

    return staged(docs.mapInArrow(measure, schema), "ngram-sets")


def frequency_ranks(measured: DataFrame) -> np.ndarray:
    """Place of each counter by its count, from the sketches of all tasks: two MiB, whatever the input."""
    rows = measured.filter("block is not null").select("block", F.pmod(F.xxhash64("counts"), F.lit(1024)).alias("salt"), "counts")

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(SKETCH_BLOCK, np.uint64)
        for c in pdf["counts"]:
            counts += np.frombuffer(c, np.uint64 if len(c) == SKETCH_BLOCK * 8 else np.uint32)
        return pd.DataFrame({"block": pdf["block"][:1], "counts": [counts.tobytes()]})

    schema = "block int, counts binary"
    # In two steps, so that no group holds the sketches of all tasks.
    first = rows.groupBy("block", "salt").applyInPandas(lambda pdf: total(pdf), schema)
    sums = {r["block"]: r["counts"] for r in first.groupBy("block").applyInPandas(total, schema).collect()}
    counts = np.concatenate([np.frombuffer(sums[b], np.uint64) for b in sorted(sums)]) if sums else np.zeros(1 << SKETCH_BITS)
    rank = np.unique(counts, return_inverse=True)[1]
    # The rarer ones are told apart; the few most frequent counters are one.
    return np.minimum(rank, RANKS - 1).astype(np.uint16)


def prefixes(docs: DataFrame, ranks: np.ndarray, groups: int, percent: int) -> DataFrame:
    """Second pass: prefix elements dealt out by hash, in blocks of many documents.

    A block has the keys and sizes of its documents and, for each element, 32 bits of its hash, its
    document in the block and its position in the document's order. Documents with equal sets
    are sent once per block. Elements of a group that agree in these bits by chance, some
    128 pairs among 2**20 elements, only make candidates, which the filters and the comparison drop.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def deal(batches):
        for _, words in texts_of_words(batches, "text"):
            keys, sizes, tokens, owners, places = {}, [], [], [], []
            for w in words:
                u = np.unique(shingles(w, SHINGLE_WORDS))
                if not len(u) or (key := set_key(u)) in keys:
                    continue
                keys[key] = len(keys)
                order = np.lexsort((u, sent.value[(u >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
                p = prefix_length(len(u), percent)
                sizes.append(len(u))
                tokens.append(u[order[:p]])
                owners.append(np.full(p, keys[key], np.int32))
                places.append(np.arange(p, dtype=np.int32))
            if not keys:
                continue
            tokens, owners, places = map(np.concatenate, (tokens, owners, places))
            group = ((tokens >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            bounds = np.searchsorted(group[order], np.arange(groups + 1))
            names, sizes = np.frombuffer(b"".join(keys), "V16"), np.array(sizes, np.int32)
            for g in np.flatnonzero(np.diff(bounds)):
                at = order[bounds[g] : bounds[g + 1]]
                used, own = np.unique(owners[at], return_inverse=True)
                bits = (mixed(tokens[at]) >> np.uint64(32)).astype(np.uint32)
                values = [names[used], sizes[used], bits, own.astype(np.int32), places[at]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in values]],
                    ["grp", "keys", "sizes", "tokens", "owners", "places"],
                )

    return docs.mapInArrow(deal, "grp int, keys binary, sizes binary, tokens binary, owners binary, places binary")


def possible(m: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Length filter."""
    return np.minimum(m, n) * 100 >= percent * np.maximum(m, n)


def meetings(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Who meets whom among the documents of one group: (``c``, ``key``, ``place``).

    Documents that share an element are a run; it belongs to the cluster named by its first
    document. ``place`` is the least position of an element that brought a document into a cluster.
    A document leaves a run where with none of the others the lengths allow the overlap and, from the
    positions of the shared element on, enough elements are left. Two that are linked stay together in
    the run of the first element they share. Runs of over :data:`RUN_MEMBERS` stay whole.
    """
    keys = np.concatenate([np.frombuffer(k, "V16") for k in pdf["keys"]])
    starts = np.cumsum([0] + [len(k) // 16 for k in pdf["keys"]])
    names, ids = np.unique(keys, return_inverse=True)
    sizes = np.zeros(len(names), np.int64)
    sizes[ids] = np.concatenate([np.frombuffer(s, np.int32) for s in pdf["sizes"]])
    tokens = np.concatenate([np.frombuffer(t, np.uint32) for t in pdf["tokens"]])
    owners = ids[np.concatenate([np.frombuffer(o, np.int32) + s for o, s in zip(pdf["owners"], starts)])]
    places = np.concatenate([np.frombuffer(p, np.int32) for p in pdf["places"]]).astype(np.int64)
    order = np.lexsort((owners, tokens))
    tokens, owners, places = tokens[order], owners[order], places[order]
    new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])])
    tokens, owners, places = tokens[new], owners[new], places[new]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    length = np.diff(np.append(first, len(tokens)))
    kept = with_partner(sizes[owners], places, first, length, percent)
    tokens, owners, places = tokens[kept], owners[kept], places[kept]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])[: len(tokens)])
    lead = np.repeat(owners[first], np.diff(np.append(first, len(tokens))))
    rows = pd.DataFrame({"c": lead, "key": owners, "place": places}).groupby(["c", "key"], as_index=False)["place"].min()
    return pd.DataFrame({"c": as_bytes(names[rows["c"]]), "key": as_bytes(names[rows["key"]]), "place": rows["place"].astype(np.int32)})


def with_partner(n: np.ndarray, place: np.ndarray, first: np.ndarray, length: np.ndarray, percent: int) -> np.ndarray:
    """Which members of runs pass the length and positional filter with another one of their run; all of a long run."""
    size = np.repeat(length, length)
    left = np.repeat(first + length, length)
    kept = size > RUN_MEMBERS
    at = np.flatnonzero((size > 1) & ~kept)
    for step in range(1, RUN_MEMBERS):
        at = at[at + step < left[at]]
        if not len(at):
            break
        x, y = at, at + step
        enough = np.minimum(n[x] - place[x], n[y] - place[y]) >= least_overlap(n[x], n[y], percent)
        ok = possible(n[x], n[y], percent) & enough
        kept[x[ok]] = kept[y[ok]] = True
    return kept


def as_bytes(keys: np.ndarray) -> list[bytes]:
    return [k.tobytes() for k in keys]


def may_be_linked(rows: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Length, positional and suffix filter of pairs of rows.

    The suffix filter counts elements in ranges of their hashes: the differences of the counts bound
    the size of the symmetric difference from below. Pairs of large sets that pass it are tried
    once more with ranges as fine as the sets.
    """
    m, n = rows["n"][x], rows["n"][y]
    need = least_overlap(m, n, percent)
    ok = possible(m, n, percent) & (np.minimum(m - rows["place"][x], n - rows["place"][y]) >= need)
    at = np.flatnonzero(ok)
    for part in np.array_split(at, max(1, len(at) // 50_000)):
        apart = np.abs(rows["ranges"][x[part]] - rows["ranges"][y[part]]).sum(axis=1, dtype=np.int64)
        ok[part] = apart <= (m + n - 2 * need)[part]
    fine = rows["fine"]
    for p in np.flatnonzero(ok):
        if fine[x[p]] and fine[y[p]]:
            ok[p] = fine_distance(fine[x[p]], fine[y[p]]) <= m[p] + n[p] - 2 * need[p]
    return ok


PAIRS = ["a", "b", "c", "id_a", "id_b", "words"]


def pairs_of(pdf: pd.DataFrame, percent: int, stars: bool) -> pd.DataFrame:
    """Pairs to verify among the cluster blocks of a group.

    ``stars``: every member with the first documents of its block, of which the cluster's first is
    one. That joins most of a group that belongs together. Else: members in different components, of one block or of the two blocks that the rows bring together.
    """
    pdf = pdf.sort_values(["c", "i", "j", "key"], ignore_index=True)
    rows = {
        "n": pdf["n"].to_numpy(np.int64),
        "place": pdf["place"].to_numpy(np.int64),
        "ranges": counts_of(b"".join(pdf["ranges"])).reshape(-1, SUFFIX_RANGES),
        "fine": pdf["fine"].to_numpy(),
    }
    same = (pdf[["c", "i", "j"]].shift() == pdf[["c", "i", "j"]]).all(axis=1).to_numpy()
    first = np.flatnonzero(~same)
    length = np.diff(np.append(first, len(pdf)))
    if stars:
        start = np.repeat(first, length)
        offset = np.arange(len(pdf)) - start
        found = [np.zeros((2, 0), np.int64)]
        for step in range(PIVOTS):
            y = np.flatnonzero(offset > step)
            x = start[y] + step
            ok = may_be_linked(rows, x, y, percent)
            found.append(np.stack([x[ok], y[ok]]))
        x, y = np.concatenate(found, axis=1)
    else:
        part, block = pd.factorize(pdf["component"])[0], pdf["block"].to_numpy()
        found = [np.zeros((2, 0), np.int64)]
        i, j = pdf["i"].to_numpy(), pdf["j"].to_numpy()
        for f, k in zip(first, length):
            at = np.arange(f, f + k)
            left = at[block[at] == i[f]]
            right = at[block[at] == j[f]]
            # Row by row of the left block, so that memory grows with one block only.
            for v in left:
                y = right[right > v] if i[f] == j[f] else right
                y = y[part[y] != part[v]]
                x = np.full(len(y), v)
                ok = may_be_linked(rows, x, y, percent)
                found.append(np.stack([x[ok], y[ok]]))
        x, y = np.concatenate(found, axis=1)
    key, ids, n = pdf["key"].to_numpy(), pdf["id"].to_numpy(), rows["n"]
    swap = np.array([key[p] > key[q] for p, q in zip(x, y)], bool)
    x, y = np.where(swap, y, x), np.where(swap, x, y)
    return pd.DataFrame(
        {"a": key[x], "b": key[y], "c": pdf["c"].to_numpy()[x], "id_a": ids[x], "id_b": ids[y], "words": n[x] + n[y]}, columns=PAIRS
    )


def candidates(clusters: DataFrame, percent: int, stars: bool) -> DataFrame:
    """Pairs that pass the filters, from rows (c, key, place, id, n, ranges, fine, blocks) of clusters.

    A large cluster is cut into blocks. For ``stars`` its first document goes to every block; else
    every block meets every other, each pair of blocks as a group of its own.
    """
    rows = clusters.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    if stars:
        rows = rows.withColumn("i", F.explode(F.when(F.col("key") == F.col("c"), every).otherwise(F.array("block"))))
        rows = rows.withColumn("j", F.col("i"))
    else:
        # Rows of a cut cluster go to every block: without their fine counts.
        rows = rows.withColumn("fine", F.when(F.col("blocks") > 1, F.lit(b"")).otherwise(F.col("fine")))
        rows = rows.withColumn("other", F.explode(every))
        rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    ids = clusters.schema["id"].dataType
    groups = max(12, rows.count() // GROUP_ROWS)
    schema = T.StructType(
        [T.StructField(f, t) for f, t in zip(PAIRS, [T.BinaryType(), T.BinaryType(), T.BinaryType(), ids, ids, T.LongType()])]
    )
    rows = rows.withColumn("grp", F.pmod(F.xxhash64("c", "i", "j"), F.lit(groups)))
    return staged(rows.groupBy("grp").applyInPandas(lambda pdf: pairs_of(pdf, percent, stars), schema), "ngram-pairs")


def verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of keys among candidate pairs, each compared once over its whole sets.

    Pairs are dealt out by cluster, large clusters in parts, and the texts they need follow them.
    Every task contracts its links to a spanning forest.
    """
    pairs = pairs.groupBy("a", "b").agg(F.min("c").alias("c"), *[F.first(x).alias(x) for x in ("id_a", "id_b", "words")])
    pairs = staged(pairs, "ngram-distinct")
    # Of all pairs, one cluster in CLUSTER_PAIRS at most is large.
    large = pairs.groupBy("c").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > CLUSTER_PAIRS)
    parts = F.coalesce(F.ceil(F.col("__n") / CLUSTER_PAIRS), F.lit(1))
    words = pairs.agg(F.sum("words")).first()[0] or 0
    pairs = pairs.join(broadcast_if_small(large), "c", "left").withColumn("__c", F.xxhash64("c", F.pmod(F.xxhash64("b"), parts)))
    groups = max(12, -(-words // GROUP_WORDS))
    pairs = pairs.select(F.pmod(F.col("__c"), F.lit(groups)).cast("int").alias("grp"), "a", "b", "id_a", "id_b")
    needed = staged(
        pairs.select("grp", F.col("id_a").alias("id")).unionByName(pairs.select("grp", F.col("id_b").alias("id"))).distinct(), "ngram-needed"
    )
    with_text = docs.select("id", "text").join(broadcast_if_small(needed), "id").select("grp", "id", "text")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        batch = pa.RecordBatch.from_arrays([pa.array(right["text"], pa.large_string())], ["text"])
        sets = {}
        for _, run in texts_of_words(iter([batch]), "text"):
            for w in run:
                u = np.unique(shingles(w, SHINGLE_WORDS))
                sets[set_key(u)] = u
        links = []
        for a, b in zip(left["a"], left["b"]):
            x, y = sets[a], sets[b]
            common = len(np.intersect1d(x, y, assume_unique=True))
            if common * 100 >= percent * (len(x) + len(y) - common):
                links.append((a, b))
        return pd.DataFrame(forest(links), columns=["a", "b"])

    return staged(pairs.groupBy("grp").cogroup(with_text.groupBy("grp")).applyInPandas(compare, "a binary, b binary"), "ngram-links")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents are linked when their sets of 5-word shingles have a Jaccard similarity of at
    least ``percent`` / 100; a component is what links join, named by its smallest id. Words are
    cut at white space, A-Z lower-cased; a text with fewer words has its whole sequence as one
    shingle. Null and empty texts have no shingle, no link and their own id as component. A null
    id has a null component and links nothing. Rows that repeat an id are one node: what links to
    one of its texts links to all. Other columns are not read, whatever their names; an empty table gives none.

    Documents with equal sets are one class, which is compared once and joined by its key, never
    expanded into pairs.
    """
    found = grouped(docs, doc_id, text, percent, by_id=True)
    return found.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id")


def grouped(docs: DataFrame, doc_id: str, text: str, percent: int, by_id: bool) -> DataFrame:
    """(id, hash, n, component_id) of each row, ``hash`` being that of its text.

    The nodes are classes of equal sets. With ``by_id``, those that share an id are joined too, and
    ``component_id`` is the smallest id; else it is the key of a class, null without a set.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    measured = measured_sets(rows)
    sets = measured.filter("block is null").select("id", "hash", "n", "key", "ranges", "fine")
    classes = sets.filter("key is not null and id is not null").groupBy("key").agg(
        F.min("id").alias("id"), F.max("n").alias("n"), F.max("ranges").alias("ranges"), F.max("fine").alias("fine"), F.count(F.lit(1)).alias("members")
    )
    classes = staged(classes, "ngram-classes")
    tokens = classes.agg(F.sum("n")).first()[0] or 0
    groups = max(12, math.ceil(tokens * (100 - percent) / 100 / GROUP_TOKENS))
    met = prefixes(rows.filter("id is not null"), frequency_ranks(measured), groups, percent)
    met = met.groupBy("grp").applyInPandas(lambda pdf: meetings(pdf, percent), "c binary, key binary, place int")
    met = met.groupBy("c", "key").agg(F.min("place").alias("place"))
    clusters = staged(met.join(classes.select("key", "id", "n", "ranges", "fine"), "key"), "ngram-clusters")
    large = clusters.groupBy("c").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > BLOCK_MEMBERS)
    blocks = F.coalesce(F.ceil(F.col("__n") / BLOCK_MEMBERS), F.lit(1)).cast("int")
    clusters = clusters.join(broadcast_if_small(large), "c", "left").withColumn("blocks", blocks).drop("__n")
    links = verified(candidates(clusters, percent, stars=True), rows, percent)
    twice = repeated(sets) if by_id else None
    if by_id:
        links = links.unionByName(twice.filter("key != a").select("a", F.col("key").alias("b")))
    found = staged(components(links), "ngram-components")
    # What is left: members of one cluster that no chain of links joins.
    parted = clusters.drop("ranges", "fine").join(found.withColumnRenamed("node", "key"), "key", "left")
    parted = staged(parted.withColumn("component", F.coalesce("component", "key")), "ngram-members")
    apart = parted.groupBy("c").agg(F.count(F.lit(1)).alias("__n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    apart = apart.filter("__n > 2 and lo != hi").select("c", "__n")
    left = staged(join_groups(parted, staged(apart, "ngram-apart"), "c", "__n", parted.count(), HOT_ROWS).drop("__n"), "ngram-parted")
    if not left.isEmpty():
        # Counts come to the rows last, and only those that are needed.
        some = broadcast_if_small(staged(left.select("key").distinct(), "ngram-left"))
        counted = left.join(classes.select("key", "ranges", "fine").join(some, "key", "left_semi"), "key")
        late = verified(candidates(counted, percent, stars=False), rows, percent)
        found = staged(components(links.unionByName(late)), "ngram-components")
    if not by_id:
        of_key = classes.join(found.withColumnRenamed("node", "key"), "key", "left")
        return with_class(sets, staged(of_key.select("key", "members", F.coalesce("component", "key").alias("component_id")), "ngram-lead"))
    # A component is named by its smallest id; what no link joins is a component by itself.
    named = staged(classes.select("key", "id").join(found.withColumnRenamed("node", "key"), "key"), "ngram-named")
    least = named.groupBy("component").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("__n"))
    named = join_groups(named, least, "component", "__n", named.count(), HOT_ROWS).select("key", "component_id")
    lead = staged(classes.join(named, "key", "left").select("key", "members", F.coalesce("component_id", "id").alias("component_id")), "ngram-lead")
    # A row without a set goes with the others of its id.
    bare = twice.filter("bare and a = key").join(lead, "key")
    lead = lead.unionByName(bare.select(no_set(F.xxhash64("id")).alias("key"), F.lit(0).cast("long").alias("members"), "component_id"))
    out = with_class(sets, lead)
    return out.withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))


def repeated(sets: DataFrame) -> DataFrame:
    """(id, key, a, bare) of the ids that occur with different sets, or also without one (``bare``):
    their keys and the least of them."""
    ids = sets.filter("id is not null").groupBy("id").agg(
        F.min("key").alias("a"), F.max("key").alias("hi"), (F.count("key") < F.count(F.lit(1))).alias("bare")
    )
    ids = staged(ids.filter("a is not null and (bare or a != hi)").drop("hi"), "ngram-repeated")
    return staged(sets.filter("key is not null").select("id", "key").join(broadcast_if_small(ids), "id").distinct(), "ngram-same-id")


def no_set(hash_: Column) -> Column:
    """Key of a row without a set, by the hash of its id."""
    return F.concat(F.lit(b"none"), F.unhex(F.hex(hash_)))


def with_class(sets: DataFrame, lead: DataFrame) -> DataFrame:
    """The documents with the component of their class. Classes of at least 1/1000 of all documents
    are broadcast (there are at most 1000); classes of one document are that document."""
    total = sets.count()
    hot = F.broadcast(lead.filter(F.col("members") * 1000 >= total).select("key", F.col("component_id").alias("hot_id")))
    rest = lead.filter(F.col("members") * 1000 < total).select("key", "component_id")
    rows = sets.select("id", "hash", "n", "key").join(hot, "key", "left")
    # Hot rows and rows without a set take a key of their own in the second join.
    own = F.when(F.col("hot_id").isNull(), F.col("key"))
    spread = F.coalesce(own, no_set(F.xxhash64("id")))
    joined = rows.withColumn("key", spread).join(rest, "key", "left")
    return joined.select("id", "hash", "n", F.coalesce("hot_id", "component_id").alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: of its smallest id. A null id stays.

    Groups are those of the texts: rows that repeat an id with another text are documents of their
    own, so no text goes without one like it that stays. Rows that repeat id and text are one.
    """
    found = staged(grouped(docs, doc_id, text, percent, by_id=False).filter("id is not null"), "ngram-grouped")
    some = staged(found.filter("component_id is not null").select("id", "hash", "component_id").distinct(), "ngram-rows")
    first = some.groupBy("component_id").agg(F.min(F.struct("id", "hash")).alias("first"), F.count(F.lit(1)).alias("__n"))
    some = join_groups(some, first.filter("__n > 1"), "component_id", "__n", some.count(), HOT_ROWS)
    gone = staged(some.filter(F.struct("id", "hash") != F.col("first")).select(F.col("id").alias("__id"), F.col("hash").alias("__gone")), "ngram-gone")
    rows = docs.withColumn("__hash", F.xxhash64(F.col(text).cast("string")))
    rows = rows.join(broadcast_if_small(gone), (F.col(doc_id) == F.col("__id")) & (F.col("__hash") == F.col("__gone")), "left_anti")
    twice = found.groupBy("id", "hash").count().filter("count > 1").select(F.col("id").alias("__id"), F.col("hash").alias("__gone"))
    twice = staged(twice, "ngram-twice")
    if not twice.isEmpty():
        twice, same = broadcast_if_small(twice), (F.col(doc_id) == F.col("__id")) & (F.col("__hash") == F.col("__gone"))
        rows = rows.join(twice, same, "left_anti").unionByName(rows.join(twice, same, "left_semi").dropDuplicates([doc_id, "__hash"]))
    return rows.drop("__hash")
