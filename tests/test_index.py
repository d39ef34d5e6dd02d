"""Index life cycle: partial updates, rebuild, swap, mismatches, streaming."""

import pytest
from pyspark.sql import functions as F

from fixture import ITEMS, LONG, documents, new_index, row
from sieveline import KEY, FieldError, SearchRequest, Term
from sieveline.sources.documents import TypeMismatch
from sieveline.streaming import index_stream


@pytest.fixture
def index(spark, tmp_path):
    return new_index(spark, tmp_path)


def names(table):
    return {r[KEY]: r["name"] for r in table.select(KEY, "name").collect()}


def test_missing_index(spark, index):
    assert index.table() is None
    result = index.search(SearchRequest())
    assert (result.documents.count(), result.total.first().total, result.facets.count()) == (0, 0, 0)
    assert index.suggest("a", ["name"]).count() == 0
    with pytest.raises(FieldError):
        index.remove(spark.createDataFrame([("x",)], f"{KEY} string"))


def test_partial_update(spark, index):
    index.index(documents(spark, ITEMS[:3]))
    change = spark.createDataFrame(
        [row("Item-1", 0, "Size", "Integer", [7]), row("Item-9", 1, "Name", "String", ["New"]),
         row("Item-1", 2, "Color", "String", ["Green"])],
        LONG,
    )
    report = {r.id: r.action for r in index.index_partial(change).collect()}
    assert report == {"Item-1": "merged", "Item-9": "inserted"}
    rows = {r[KEY]: r for r in index.table().collect()}
    assert (rows["Item-1"].size, rows["Item-1"].color, rows["Item-1"].asDict()["name"]) == (7, "Green", "Sample Product")
    assert rows["Item-9"].asDict()["name"] == "New" and rows["Item-9"].size is None
    with pytest.raises(FieldError):
        index.index_partial(spark.createDataFrame([row("Item-1", 0, "Brand", "String", ["x"])], LONG))
    assert "brand" not in index.table().columns


def test_full_update_replaces_the_whole_document(spark, index):
    index.index(documents(spark, ITEMS[:2]))
    index.index(spark.createDataFrame([row("Item-1", 0, "Name", "String", ["Only a name"])], LONG))
    found = index.get(["Item-1"]).first()
    assert found.asDict()["name"] == "Only a name" and found.color is None and found.size is None


def test_swap(spark, index):
    index.swap()
    assert index.table() is None  # nothing to publish
    index.index_with_backup(documents(spark, ITEMS[:2]))
    assert index.table() is None
    index.swap()
    assert set(names(index.table())) == {"Item-1", "Item-2"}
    assert index.table(use_backup=True).count() == 0
    index.forget_backup()
    index.index_with_backup(documents(spark, ITEMS[2:4]))
    assert set(names(index.table())) == {"Item-1", "Item-2"}
    index.swap()
    assert set(names(index.table())) == {"Item-3", "Item-4"}
    assert set(names(index.table(use_backup=True))) == {"Item-1", "Item-2"}
    assert index.search(SearchRequest(use_backup=True)).total.first().total == 2
    assert [r.viewName for r in spark.sql(f"SHOW VIEWS IN {index.database}").collect()] == ["shop_item_active", "shop_item_backup"]
    assert set(names(spark.table(index.view()))) == {"Item-3", "Item-4"}


def test_removing_all_documents(spark, index):
    index.index(documents(spark, ITEMS[:4]))
    keys = spark.createDataFrame([(i[0],) for i in ITEMS[:4]] + [("absent",)], f"{KEY} string")
    actions = sorted(r.action for r in index.remove(keys).collect())
    assert actions == ["absent"] + ["removed"] * 4
    assert index.table().count() == 0


def test_create_empty(spark, index):
    index.create(documents(spark, ITEMS[:1]))
    backup = index.table(use_backup=True)
    assert backup.count() == 0 and "price_usd" in backup.columns


def test_type_mismatch_aborts_the_batch(spark, index):
    index.index(documents(spark, ITEMS[:2]))
    wrong = [row("Item-1", 0, "Name", "String", ["Changed"]), row("Item-3", 1, "Size", "Long", [5])]
    with pytest.raises(TypeMismatch):
        index.index(spark.createDataFrame(wrong, LONG))
    assert names(index.table()) == {"Item-1": "Sample Product", "Item-2": "Red Shirt 2"}


def test_integer_into_double(spark, index):
    index.index(spark.createDataFrame([row("a", 0, "Weight", "Double", [1.5])], LONG))
    index.index(spark.createDataFrame([row("b", 0, "Weight", "Integer", [2])], LONG))
    assert {r[KEY]: r.weight for r in index.table().collect()} == {"a": 1.5, "b": 2.0}


def test_last_document_of_a_key_wins(spark, index):
    rows = [row("a", 0, "Name", "String", ["old"]), row("a", 1, "Name", "String", ["new"])]
    report = index.index(spark.createDataFrame(rows, LONG))
    assert report.count() == 1
    assert names(index.table()) == {"a": "new"}


def test_stream(spark, index, tmp_path):
    source = str(tmp_path / "in")
    documents(spark, ITEMS[:3]).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(LONG).parquet(source)

    def run():
        query = index_stream(stream, index, str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()

    run()
    assert index.table().count() == 3
    documents(spark, ITEMS[2:5]).withColumn("values", F.when(F.col("name") == "Name", F.array(F.lit("Again")))
        .otherwise(F.col("values"))).coalesce(1).write.mode("append").parquet(source)
    run()
    assert names(index.table()) == {
        "Item-1": "Sample Product", "Item-2": "Red Shirt 2", "Item-3": "Again", "Item-4": "Again", "Item-5": "Again",
    }


def test_frames_taken_before_a_change_keep_their_rows(spark, index):
    index.index(documents(spark, ITEMS[:3]))
    before, found = index.table(), index.search(SearchRequest(text="red")).documents
    index.index(spark.createDataFrame([row("Item-2", 0, "Name", "String", ["Blue Hat"])], LONG))
    index.remove(spark.createDataFrame([("Item-1",)], f"{KEY} string"))
    assert set(names(before)) == {"Item-1", "Item-2", "Item-3"} and found.count() == 3
    assert names(index.table()) == {"Item-2": "Blue Hat", "Item-3": "Red Shirt"}


def test_a_write_that_is_not_published_changes_nothing(spark, index, monkeypatch):
    index.index(documents(spark, ITEMS[:2]))
    monkeypatch.setattr(index, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.index(documents(spark, ITEMS[2:4]))
    monkeypatch.undo()
    assert set(names(index.table())) == {"Item-1", "Item-2"}
    index.index(documents(spark, ITEMS[2:4]))
    assert len(names(index.table())) == 4


def test_only_unpublished_tables_expire(spark, index):
    for n in (1, 2, 3):
        index.index(documents(spark, ITEMS[:n]))
    index.rebuild(documents(spark, ITEMS[:1]))
    assert len(index.expire()) == 2 and index.expire() == []
    assert (index.table().count(), index.table(use_backup=True).count()) == (3, 1)
    other = type(index)(spark, index.database, "Shop", "Item_2")
    other.index(documents(spark, ITEMS[:1]))
    index.forget_backup()
    assert len(index.expire()) == 1 and other.table().count() == 1 and other.expire() == []


def test_a_small_change_does_not_shuffle_the_copy(spark, index, monkeypatch):
    many = spark.range(2_000).selectExpr(
        "string(id) doc_id", "id seq", "'Name' name", "'String' type", "array(concat('name ', id)) values",
        "true searchable", "true filterable", "true retrievable", "false suggestable", "false collection",
    )
    index.index(many)
    plans = []
    store = index._store
    monkeypatch.setattr(index, "_store", lambda rows: plans.append(rows) or store(rows))
    index.index(many.filter("seq < 5").withColumn("values", F.array(F.lit("changed"))))
    index.index_partial(many.filter("seq < 5"))
    index.remove(many.filter("seq >= 1990").select(F.col("doc_id").alias(KEY)))
    assert len(plans) == 3 and index.table().count() == 1_990
    for rows in plans:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    found = index.get(["3", "1995"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(__id" in found


def test_a_replayed_batch_changes_nothing(spark, index):
    batch = spark.createDataFrame(
        [row("a", 0, "Name", "String", ["old"]), row("a", 0, "Size", "Integer", [1]), row("a", 7, "Name", "String", ["new"]),
         row(None, 8, "Name", "String", ["lost"])], LONG,
    )
    index.index(spark.createDataFrame([row("a", 3, "Color", "String", ["Red"])], LONG), continued=True)
    for _ in range(2):
        report = {r.id: r.action for r in index.index(batch, continued=True).collect()}
        assert report == {"a": "replaced", None: None}
        found = [r.asDict() for r in index.table().collect()]
        assert [(r["name"], r["size"], r["color"]) for r in found] == [("new", None, None)]


def test_rebuild_forgets_the_old_backup(spark, index):
    for items in (ITEMS[:4], ITEMS[:3], ITEMS[:1]):
        index.rebuild(documents(spark, items))
        index.swap()
        assert len(names(index.table())) == len(items)


def test_partial_after_removal_inserts(spark, index):
    index.index(documents(spark, ITEMS[:2]))
    index.remove(spark.createDataFrame([("Item-1",)], f"{KEY} string"))
    index.index_partial(spark.createDataFrame([row("Item-1", 0, "Name", "String", ["Back"])], LONG))
    again = {r[KEY]: r for r in index.table().collect()}["Item-1"]
    assert again.asDict()["name"] == "Back" and again.color is None


def test_many_fields_and_reserved_names(spark, index):
    wide = spark.range(10_500).selectExpr(
        "'a' doc_id", "0L seq", "concat('F', id) name", "'Integer' type", "array(string(id)) values",
    )
    from sieveline.sources.documents import collect_specs, infer_fields, read_documents

    assert len(collect_specs(infer_fields(read_documents(wide)))) == 10_500
    index.index(spark.createDataFrame([row("a", 0, n, "String", [n]) for n in ("Seq", "Present", "Rank", "Score")], LONG))
    found = index.get(["a"]).first()
    assert (found.seq, found.present, found.rank, found.score) == ("Seq", "Present", "Rank", "Score")
    with pytest.raises(FieldError):
        index.index(spark.createDataFrame([row("a", 0, "__seq", "String", ["x"])], LONG))


def test_take_none(spark, index):
    index.index(documents(spark, ITEMS[:5]))
    found = index.search(SearchRequest(text="red", take=None)).documents
    assert found.count() == 3
    assert index.search(SearchRequest(skip=3, take=None)).documents.count() == 2


def test_document_split_over_micro_batches(spark, index, tmp_path):
    source = str(tmp_path / "in")

    def run(rows):
        spark.createDataFrame(rows, LONG).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LONG).parquet(source)
        index_stream(stream, index, str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()

    run([row("a", 0, "Name", "String", ["first"]), row("b", 1, "Name", "String", ["other"])])
    run([row("a", 0, "Color", "String", ["Red"])])
    found = {r[KEY]: r.asDict() for r in index.table().collect()}
    assert (found["a"]["name"], found["a"]["color"]) == ("first", "Red") and found["b"]["color"] is None
    run([row("a", 7, "Color", "String", ["Blue"])])
    found = {r[KEY]: r.asDict() for r in index.table().collect()}
    assert (found["a"]["name"], found["a"]["color"]) == (None, "Blue")


def test_exact_decimals(spark, index):
    rows = [row(str(i), i, "Price", "ExactDecimal", [v]) for i, v in enumerate(["0.1", "0.10", "0.100000000000000001", "7"])]
    index.index(spark.createDataFrame(rows, LONG))
    found = index.search(SearchRequest(filter=Term("price", ["0.1"]))).documents
    assert sorted(r.id for r in found.collect()) == ["0", "1"]


def test_micro_batch_of_one_file_is_dealt_out_by_document(spark, tmp_path):
    rows = [(str(i), 1, f, "String", [str(i)]) for i in range(400) for f in ("a", "b")]
    long = spark.createDataFrame(rows, "doc_id string, seq long, name string, type string, values array<string>")
    long.coalesce(1).write.parquet(str(tmp_path / "in"))
    parts = []

    class Kept:
        def index(self, batch, continued):
            per = batch.select(F.spark_partition_id().alias("p"), "doc_id").groupBy("doc_id").agg(F.collect_set("p").alias("p")).collect()
            assert all(len(r.p) == 1 for r in per)
            parts.extend(r.p[0] for r in per)

    stream = spark.readStream.schema(long.schema).parquet(str(tmp_path / "in"))
    # Kept as they are, so that small partitions are not merged.
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "false")
    try:
        index_stream(stream, Kept(), str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning")
    assert len(parts) == 400 and len(set(parts)) == 4
