import pytest
from pyspark.sql import functions as F

from sieveline.llm import curriculum
from rows import clashing, empty_docs, odd_docs, odd_rows, words


def expected_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def test_targets_and_caps(spark):
    found = curriculum.mix_sources(clashing(spark)).collect()
    sizes = {}
    for _, text, _, source, _ in odd_rows():
        sizes[source] = sizes.get(source, 0) + len(words(text))
    target = expected_targets(sizes)
    assert len(found) == len(odd_rows())
    for r in found:
        assert r["size"] == len(words(r.text)) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken == r["size"] * r.copies <= 3 * r["size"]
        assert len(r.positions) == r.copies and all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)


def test_taken_is_near_target(spark):
    docs = spark.range(5000).selectExpr(
        "id doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) source", "repeat('word ', int(1 + id % 40)) text"
    )
    mixed = curriculum.mix_sources(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    for r in mixed.collect():
        assert abs(r.taken - r.target) <= 20
    rows = lambda: sorted(curriculum.mix_sources(docs.repartition(3)).select("doc_id", "positions").collect())
    assert rows() == rows()


def test_schedule_orders_training(spark):
    docs = spark.range(2000).selectExpr("id doc_id", "if(id % 2 = 0, 'early', 'late') source", "'one two three' text")
    schedule = spark.createDataFrame(
        [("early", 0.0, 2.0), ("early", 0.5, 0.0), ("early", 1.0, 0.0), ("late", 0.0, 0.0), ("late", 1.0, 1.0)],
        "source string, t double, weight double",
    )
    order = curriculum.training_order(curriculum.mix_sources(docs, schedule)).select("source", "position").collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert max(r.position for r in order if r.source == "early") <= 0.5
    # The late source's demand is t squared.
    late = [r.position for r in order if r.source == "late"]
    assert sum(p <= 0.5 for p in late) / len(late) == pytest.approx(0.25, abs=0.01)


def test_source_without_schedule_is_left_out(spark):
    schedule = spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.0, 1.0)], "source string, t double, weight double")
    found = curriculum.mix_sources(odd_docs(spark), schedule).collect()
    assert {r.copies for r in found if r.source != "a"} == {0}


def test_empty(spark):
    assert curriculum.mix_sources(empty_docs(spark)).count() == 0
