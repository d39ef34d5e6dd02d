"""JSON lines as documents, and paths into complex values."""

import pytest
from pyspark.sql import functions as F

from fixture import new_index
from sieveline import FieldError, Range, RangeValue, SearchRequest, SortField, Term
from sieveline.sources.documents import assemble, collect_specs, infer_fields
from sieveline.sources.variants import Path, json_documents, json_fields, rejected_lines, variant_paths, with_paths

LINES = [
    '{"id": "a", "Name": "Red Shirt", "Size": 4, "Price": 10, "tags": ["x", null, "y"], "box": {"w": 1, "of": {"kind": "k"}}}',
    '{"id": 7, "Name": "Sox", "Price": 2.5, "odd": "text", "box": {"w": 2.5, "it\'s": true}, "gone": null}',
    '{"id": "b", "odd": 3, "tags": [], "nums": [1, 2], "Born": "2017-04-28T15:24:31Z"}',
    '{"id": "e"}',
    "", "   ", None,
    '{"Name": "nameless"}', '{"id": null}', '{"id": {"x": 1}}', "[1]", '"text"', "{broken", '{"id": "c", "x": 1, "x": 2}',
]


def lines(spark, rows=LINES):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def wide(long):
    return assemble(long, collect_specs(infer_fields(long)))


def test_fields_of_lines(spark):
    found = {r.name: (r.type, r.collection, r.documents) for r in json_fields(lines(spark)).collect()}
    assert found == {
        "Name": ("String", False, 2), "Size": ("Long", False, 1), "Price": ("Double", False, 2), "tags": ("String", True, 2),
        "box": ("Variant", False, 2), "odd": ("Variant", False, 2), "nums": ("Variant", False, 1), "Born": ("String", False, 1),
    }


def test_lines_are_parsed_once_a_pass(spark):
    """However many conditions look at a line; and the types of a batch are worked out once, not with every use."""
    made = spark.range(9).select(F.concat(F.lit('{"id": '), F.to_json(F.struct("id")), F.lit("}")).alias("value"))
    for df in (json_fields(made), json_documents(made), json_documents(made).groupBy("name").count()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("parseJson") == 1, plan


def test_rejected_lines(spark):
    found = [(r.line[:6], r.reason) for r in rejected_lines(lines(spark)).orderBy("seq").collect()]
    assert found == [
        ('{"Name', "no id"), ('{"id":', "no id"), ('{"id":', "no id"), ("[1]", "no object"), ('"text"', "no object"),
        ("{broke", "no JSON"), ('{"id":', "no JSON"),
    ]


def test_documents_of_lines(spark):
    long = json_documents(lines(spark), types={"Born": "DateTime"}, searchable=["Name"])
    table = wide(long)
    rows = {r["__id"]: r for r in with_paths(table, [Path("odd_text", "odd", "$")]).collect()}
    assert set(rows) == {"a", "7", "b"}  # a document without fields has no row in long form
    assert (rows["a"].size, rows["a"].price, rows["a"].tags) == (4, 10.0, ["x", "y"]) and rows["7"].price == 2.5
    assert rows["b"].born.year == 2017 and rows["b"].tags is None and rows["a"].odd is None
    assert (rows["7"].odd_text, rows["b"].odd_text) == ("text", "3")
    assert rows["b"].nums.toPython() == [1, 2]
    flags = table.schema["name"].metadata["flags"]
    assert flags["searchable"] and not table.schema["box"].metadata["flags"]["sortable"]
    with pytest.raises(FieldError):
        json_documents(lines(spark), types={"Born": "Date"})


def test_names_that_collide_share_a_type(spark):
    found = json_fields(lines(spark, ['{"id": 1, "A b": 1}', '{"id": 2, "a_B": 1.5}'])).collect()
    assert {(r.name, r.type) for r in found} == {("A b", "Double"), ("a_B", "Double")}


def test_no_lines(spark):
    assert json_fields(lines(spark, [])).count() == 0
    assert json_documents(lines(spark, [])).count() == 0
    assert rejected_lines(lines(spark, [])).count() == 0


def test_paths(spark):
    table = wide(json_documents(lines(spark)))
    found = {r.path: (r.type, r.rows) for r in variant_paths(table, "box").collect()}
    assert found == {"$['w']": ("double", 2), "$['of']['kind']": ("string", 1), "$[\"it's\"]": ("boolean", 1)}
    shallow = {r.path: r.json_type for r in variant_paths(table, "box", depth=1).collect()}
    assert shallow["$['of']"] == "OBJECT<kind: STRING>"
    rows = with_paths(table, [Path("w", "box", "$.w", "double"), Path("wrong", "box", "$.of", "bigint")])
    assert {r["__id"]: (r.w, r.wrong) for r in rows.collect()} == {"a": (1.0, None), "7": (2.5, None), "b": (None, None)}
    text = spark.createDataFrame([('{"w": 3}',), ("no json",), (None,)], "box string")
    assert [r.w for r in with_paths(text, [Path("w", "box", "$.w", "bigint")]).collect()] == [3, None, None]
    for bad in (Path("size", "box", "$.w"), Path("p", "size", "$.w"), Path("p", "box", "$.w", "geo")):
        with pytest.raises(FieldError):
            with_paths(table, [bad])


def test_an_index_of_json_lines(spark, tmp_path):
    index = new_index(spark, tmp_path)
    index.index(json_documents(lines(spark)))
    index.index(json_documents(lines(spark, ['{"id": "a", "Name": "Blue", "box": {"w": 9}}'])))
    rows = with_paths(index.table(), [Path("w", "box", "$.w", "double")])
    from sieveline import search

    request = SearchRequest(filter=Range("w", [RangeValue("2")]), sort=[SortField("w", descending=True)])
    assert [(r.id, r.w) for r in search(rows, request).documents.collect()] == [("a", 9.0), ("7", 2.5)]
    assert search(rows, SearchRequest(filter=Term("w", ["9"]))).total.first().total == 1


def test_only_the_paths_in_use_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    wide(json_documents(lines(spark))).write.parquet(path)
    table = with_paths(spark.read.parquet(path), [Path("w", "box", "$.w", "double"), Path("kind", "box", "$.of.kind")])
    plan = table.filter(F.col("w") > 1).select("w")._jdf.queryExecution().executedPlan().toString()
    assert "odd" not in plan.split("ReadSchema")[1] and "kind" not in plan and "Exchange" not in plan


def test_lines_are_not_shuffled(spark):
    fields = json_fields(lines(spark))
    long = json_documents(lines(spark), fields=fields)
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "SortMergeJoin" not in plan
