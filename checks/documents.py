"""From long-form documents to tables, and changes to tables."""

from pyspark.sql import functions as F, types as T

from sieveline import KEY, DocumentIndex, FieldSpec
from sieveline.schema import normalize_name_column
from sieveline.sizing import work_folder
from sieveline.sources.documents import (
    FieldOf,
    assemble,
    check_types,
    collect_specs,
    complex_to_json,
    infer_fields,
    merge_duplicate_fields,
    read_documents,
    with_key,
)
from sieveline.sources.mutations import evolve, merge_update, mutation_report, remove, upsert
from sieveline.streaming import index_stream

from .registry import one, part_fields, part_long, query, table


@query("SELECT c_custkey::VARCHAR AS __id, c_name, c_mktsegment FROM customer")
def key_injection(spark, sf):
    df = spark.read.parquet(f"{sf}/customer.parquet")
    return with_key(df, "c_custkey").select(KEY, "c_name", "c_mktsegment")


@query("""SELECT name, type, count(*) AS n, sum(len(vals))::BIGINT AS n_values FROM (
      SELECT 'Name' AS name, 'String' AS type, [p_name] AS vals FROM part
      UNION ALL SELECT 'Brand', 'String', [p_brand] FROM part UNION ALL SELECT 'Size', 'Integer', [p_size::VARCHAR] FROM part
      UNION ALL SELECT 'Price', 'Decimal', [p_retailprice::VARCHAR] FROM part
      UNION ALL SELECT 'Tags', 'String', string_split(p_name, ' ') FROM part) GROUP BY ALL""")
def fields_long_scan(spark, sf):
    long = read_documents(part_long(spark, sf))
    return long.groupBy("name", "type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("values")).cast("bigint").alias("n_values")
    )


ODD_NAMES = {"One--Two..Three  Four": "p_name", "Brand (2)": "p_brand", "already_fine": "p_type", "Größe": "p_size"}


@query(r"""SELECT name, lower(regexp_replace(name, '[^\p{L}\p{Mn}\p{Nd}\p{Pc}]', '_', 'g')) AS field, count(*) AS n
    FROM (SELECT unnest(['One--Two..Three  Four', 'Brand (2)', 'already_fine', 'Größe']) AS name FROM part) GROUP BY ALL""")
def normalize_field_names(spark, sf):
    long = part_long(spark, sf, {name: FieldOf(one(column)) for name, column in ODD_NAMES.items()})
    return long.groupBy("name", normalize_name_column(F.col("name")).alias("field")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey::VARCHAR AS doc_id, 'brand_name' AS field, concat_ws('|', p_brand, p_name, p_type) AS vals FROM part
    UNION ALL SELECT p_partkey::VARCHAR, 'size', p_size::VARCHAR FROM part
    UNION ALL SELECT p_partkey::VARCHAR, 'words', replace(p_name, ' ', '|') || '|' || p_type FROM part""")
def merge_colliding_fields(spark, sf):
    fields = {
        # A scalar first field gives its first value only, later ones give all of theirs.
        "Brand Name": FieldOf(F.array("p_brand", "p_type"), collection=False),
        "brand_name": FieldOf(F.array("p_name", "p_type"), collection=False),
        "Size": FieldOf(one("p_size"), "Integer"),
        "Words": FieldOf(F.split("p_name", " "), collection=True),
        "words": FieldOf(F.array("p_type"), collection=True),
    }
    merged = merge_duplicate_fields(part_long(spark, sf, fields))
    return merged.select("doc_id", "field", F.array_join("values", "|").alias("vals"))


def changing_fields() -> dict[str, FieldOf]:
    """Types that differ from document to document: the first one counts."""
    kind = F.when(F.col("p_partkey") % 2 == 0, "Integer").otherwise("Long")
    late = F.when(F.col("p_partkey") >= 7, one("p_type"))
    return part_fields(
        Size=FieldOf(one("p_size"), kind),
        Late=FieldOf(late, F.when(F.col("p_partkey") % 7 == 0, "Char").otherwise("Boolean"), searchable=True),
        Spot=FieldOf(F.array(F.lit("1,2")), "GeoPoint"),
        Extra=FieldOf(one("p_type"), "Complex", filterable=False, retrievable=False),
    )


CHANGING_SQL = """(SELECT p_partkey AS seq, 'size' AS field, CASE WHEN p_partkey % 2 = 0 THEN 'int' ELSE 'bigint' END AS type FROM part
    UNION ALL SELECT p_partkey, 'late', CASE WHEN p_partkey % 7 = 0 THEN 'string' ELSE 'boolean' END FROM part WHERE p_partkey >= 7
    UNION ALL SELECT p_partkey, unnest(['name', 'brand', 'price', 'tags', 'spot', 'extra']),
      unnest(['string', 'string', 'double', 'array<string>', 'geo', 'string']) FROM part)"""


@query(f"SELECT field, arg_min(type, seq) AS type FROM {CHANGING_SQL} GROUP BY field")
def infer_field_types(spark, sf):
    return infer_fields(part_long(spark, sf, changing_fields())).select("field", "type")


@query(f"""WITH types AS (SELECT field, arg_min(type, seq) AS type FROM {CHANGING_SQL} GROUP BY field),
    fields AS (SELECT field, type, field <> 'extra' AS retrievable, field IN ('name', 'late') AND type = 'string' AS searchable,
        field <> 'extra' AS filterable, field NOT IN ('extra', 'spot') AS facetable,
        field NOT IN ('extra', 'tags') AS sortable, field = 'name' AS suggestable FROM types)
    SELECT * FROM fields UNION ALL SELECT * REPLACE (field || '__suggest' AS field) FROM fields WHERE suggestable""")
def infer_field_flags(spark, sf):
    return infer_fields(part_long(spark, sf, changing_fields()), markers=True)


@query("""SELECT p_partkey::VARCHAR AS doc_id, 'size' AS field, 'string' AS doc_type, 'int' AS schema_type FROM part WHERE p_partkey % 50 = 49
    UNION ALL SELECT p_partkey::VARCHAR, 'size', 'bigint', 'int' FROM part WHERE p_partkey % 50 = 48""")
def type_mismatches(spark, sf):
    place = F.col("p_partkey") % 50
    size_type = F.when(place == 49, "String").when(place == 48, "Long").otherwise("Integer")
    price_type = F.when(place == 3, "Long").when(place == 4, "Integer").otherwise("Double")
    fields = part_fields(Size=FieldOf(one("p_size"), size_type), Price=FieldOf(one("p_size"), price_type))
    long = part_long(spark, sf, fields)
    return check_types(long, collect_specs(infer_fields(long)))


@query("""SELECT p_partkey::VARCHAR AS __id, p_brand AS brand, p_name AS name, p_retailprice AS price, p_size AS size,
    replace(p_name, ' ', '|') AS tags FROM part""")
def assemble_documents(spark, sf):
    long = part_long(spark, sf)
    wide = assemble(long, collect_specs(infer_fields(long)))
    return wide.drop("__seq").withColumn("tags", F.array_join("tags", "|"))


@query("""SELECT o_orderkey, '{"status":"' || o_orderstatus || '"' ||
      CASE WHEN o_orderpriority <> '5-LOW' THEN ',"priority":"' || o_orderpriority || '"' ELSE '' END ||
      ',"of":{"customer":' || o_custkey || '}}' AS json FROM orders""", name="complex_to_json")
def complex_to_json_text(spark, sf):
    value = F.struct(
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.struct(F.col("o_custkey").alias("customer"), F.lit(None).cast("string").alias("nothing")).alias("of"),
    )
    return table(spark, sf, "orders").select("o_orderkey", complex_to_json(value).alias("json"))


def part_table(spark, sf):
    return table(spark, sf, "part").select(KEY, "p_partkey", "p_name", "p_size", "p_retailprice")


COLUMNS = "p_partkey::VARCHAR AS __id, p_partkey, p_name, p_size, p_retailprice"


@query(f"""SELECT {COLUMNS}, NULL::VARCHAR AS note FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 <> 0
    UNION ALL SELECT p_partkey::VARCHAR, p_partkey, p_name, NULL::INT, p_retailprice * 2, 'second' FROM part WHERE p_partkey % 3 = 0""")
def upsert_replace(spark, sf):
    part = part_table(spark, sf)
    # Two documents per key: the later one counts.
    first = part.filter("p_partkey % 3 = 0").withColumns({"seq": F.lit(1), "note": F.lit("first")})
    second = first.withColumns(
        {"seq": F.lit(2), "note": F.lit("second"), "p_retailprice": F.col("p_retailprice") * 2, "p_size": F.lit(None).cast("int")}
    )
    return upsert(part.filter("p_partkey % 2 = 0"), first.unionByName(second))


@query("""SELECT coalesce(b.p_partkey, u.p_partkey)::VARCHAR AS __id, CASE WHEN u.p_partkey IS NOT NULL THEN u.p_partkey ELSE b.p_partkey END AS p_partkey,
      CASE WHEN u.p_partkey % 5 = 0 THEN NULL ELSE b.p_name END AS p_name, b.p_size AS p_size,
      CASE WHEN u.p_partkey IS NOT NULL THEN u.p_retailprice * 2 ELSE b.p_retailprice END AS p_retailprice
    FROM (SELECT * FROM part WHERE p_partkey % 2 = 0) b FULL JOIN (SELECT * FROM part WHERE p_partkey % 3 = 0) u ON b.p_partkey = u.p_partkey""")
def partial_update(spark, sf):
    part = part_table(spark, sf)
    batch = part.filter("p_partkey % 3 = 0").select(
        KEY,
        "p_partkey",
        F.lit(None).cast("string").alias("p_name"),
        (F.col("p_retailprice") * 2).alias("p_retailprice"),
        F.lit(1).alias("seq"),
        # Every fifth document also sets its name, to null.
        F.when(F.col("p_partkey") % 5 == 0, F.array(F.lit("p_partkey"), F.lit("p_retailprice"), F.lit("p_name")))
        .otherwise(F.array(F.lit("p_partkey"), F.lit("p_retailprice")))
        .alias("present"),
    )
    return merge_update(part.filter("p_partkey % 2 = 0"), batch)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 250000)")
def remove_documents(spark, sf):
    orders = table(spark, sf, "orders")
    gone = orders.filter("o_orderstatus = 'F' AND o_totalprice < 250000")
    return remove(orders, gone).select("o_orderkey", "o_orderstatus")


@query("""SELECT p_partkey::VARCHAR AS id, true AS succeeded, NULL::VARCHAR AS error_message,
    CASE WHEN p_partkey % 2 = 0 THEN 'replaced' ELSE 'inserted' END AS action FROM part WHERE p_partkey % 3 = 0""", name="mutation_report")
def upsert_report(spark, sf):
    part = part_table(spark, sf)
    return mutation_report(part.filter("p_partkey % 2 = 0"), part.filter("p_partkey % 3 = 0"), "upsert")


@query("""SELECT p_partkey::VARCHAR AS __id, p_name, NULL::DOUBLE AS weight, NULL::VARCHAR AS origin FROM part WHERE p_partkey % 2 = 0
    UNION ALL SELECT p_partkey::VARCHAR, p_name, p_size / 2.0, 'new' FROM part WHERE p_partkey % 2 = 1""")
def schema_evolution(spark, sf):
    part = part_table(spark, sf)
    old = part.filter("p_partkey % 2 = 0").select(KEY, "p_name")
    new = part.filter("p_partkey % 2 = 1").select(
        KEY, "p_name", (F.col("p_size") / 2).alias("weight"), F.lit("new").alias("origin"), F.lit(1).alias("seq")
    )
    specs = [FieldSpec("weight", T.DoubleType()), FieldSpec("origin", T.StringType())]
    return upsert(evolve(old, specs), new)


def new_index(spark, scope: str) -> DocumentIndex:
    """A fresh index in a database of its own, which lies in the folder all executors share."""
    import uuid

    database = f"parts_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_folder(spark)}/{database}'")
    return DocumentIndex(spark, database, scope, "Part")


@query("""SELECT p_partkey::VARCHAR AS __id, p_name AS name, p_retailprice * 2 AS price, p_size AS size FROM part WHERE p_partkey % 4 <> 0""")
def rebuild_then_publish(spark, sf):
    index = new_index(spark, "Shop")
    index.index(part_long(spark, sf))
    doubled = part_fields(Price=FieldOf(F.array((F.col("p_retailprice") * 2).cast("string")), "Double"))
    index.index_with_backup(part_long(spark, sf, doubled).filter("doc_id % 4 <> 0"))
    index.swap()
    return spark.table(index.view()).select(KEY, "name", "price", "size")


@query("SELECT p_partkey::VARCHAR AS __id, p_name AS name FROM part WHERE p_partkey % 6 = 0")
def rebuild_twice(spark, sf):
    index = new_index(spark, "Again")
    long = part_long(spark, sf)
    for kept in (1, 2, 6):
        index.rebuild(long.filter(f"doc_id % {kept} = 0"))
        index.swap()
    return index.table().select(KEY, "name")


@query("""SELECT p_partkey::VARCHAR AS __id, p_name AS name, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS size,
      CASE WHEN p_partkey % 4 = 0 THEN p_type END AS kind, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS brand
    FROM part WHERE p_partkey % 7 <> 0""")
def index_lifecycle(spark, sf):
    index = new_index(spark, "Life")
    long = part_long(spark, sf)
    index.index(long)
    fresh = {k: f for k, f in part_fields(Kind=FieldOf(one("p_type"))).items() if k != "Brand"}
    index.index(part_long(spark, sf, fresh).filter("doc_id % 4 = 0"))
    bigger = {"Size": FieldOf(F.array((F.col("p_size") + 1).cast("string")), "Integer")}
    index.index_partial(part_long(spark, sf, bigger).filter("doc_id % 5 = 0"))
    index.remove(table(spark, sf, "part").filter("p_partkey % 7 = 0"))
    return index.table().select(KEY, "name", "size", "kind", "brand")


@query("SELECT p_partkey::VARCHAR AS __id, p_name AS name, p_size AS size FROM part")
def streaming_index(spark, sf):
    index = new_index(spark, "Stream")
    schema = spark.read.parquet(f"{sf}/part.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "part.parquet").parquet(sf)
    from sieveline.sources.documents import to_long

    long = to_long(stream, F.col("p_partkey"), F.col("p_partkey"), part_fields())
    run = index_stream(long, index, f"{work_folder(spark)}/{index.database}-checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return index.table().select(KEY, "name", "size")
