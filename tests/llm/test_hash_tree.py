from collections import Counter
import zlib

import pytest
from pyspark.sql import functions as F

from sieveline.llm import hash_tree
from sieveline.llm.hash_tree import Shard
from rows import clashing, empty_docs, odd_rows


def test_columns(spark):
    found = hash_tree.shard_documents(clashing(spark)).collect()
    assert len(found) == len(odd_rows())
    for r in found:
        data = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    slots = Counter((r.shard, r.slot) for r in found)
    counts = Counter(r.shard for r in found)
    assert set(slots) == {(s, i) for s, n in counts.items() for i in range(n)} and max(slots.values()) == 1


def test_growth_moves_rows_only_into_the_new_shard(spark):
    docs = spark.range(20_000).selectExpr("id doc_id")
    for n in (24, 29):
        old = hash_tree.place(docs, hash_tree.shard_tree(n)).withColumnRenamed("shard", "old")
        rows = hash_tree.place(old, hash_tree.shard_tree(n + 1)).collect()
        assert {r.shard for r in rows if r.shard != r.old} == {n}
        share = sum(r.shard == n for r in rows) / len(rows)
        assert share == pytest.approx(1 / (n + 1), rel=0.25)


def test_shares_follow_weights_and_movement_stays_in_changed_subtrees(spark):
    tree = [Shard(0, 0, 0, 1.0), Shard(1, 0, 0, 3.0), Shard(2, 0, 1, 2.0), Shard(3, 1, 0, 4.0), Shard(4, 1, 1, 2.0)]
    docs = spark.range(30_000).selectExpr("id doc_id")
    rows = hash_tree.place(docs, tree).collect()
    counts = Counter(r.shard for r in rows)
    for s in tree:
        assert counts[s.shard] / 30_000 == pytest.approx(s.weight / 12, rel=0.06)
    # A heavier shard 1: rows move only into region 0, and region 1 only loses rows.
    heavier = [Shard(s.shard, s.region, s.rack, 5.0 if s.shard == 1 else s.weight) for s in tree]
    after = {r.doc_id: r for r in hash_tree.place(docs, heavier).collect()}
    for r in rows:
        new = after[r.doc_id]
        if new.region == 1:
            assert (new.rack, new.shard) == (r.rack, r.shard) and r.region == 1
        if r.region == 0:
            assert new.region == 0
            if r.rack == 1 and new.rack == 1:
                assert new.shard == r.shard


def test_slots_of_one_heavy_shard(spark):
    placed = spark.range(10_000).selectExpr("id doc_id", "int(id % 3 = 0) shard")
    slots = hash_tree.with_slots(placed).groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect()
    assert all(r.s == list(range(len(r.s))) for r in slots)


def test_empty_and_bad_weights(spark):
    assert hash_tree.shard_documents(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        hash_tree.place(empty_docs(spark), [Shard(0, 0, 0, 0.0)])
