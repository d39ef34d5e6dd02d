"""JSON lines to documents, and searches by paths into complex values."""

from pyspark.sql import functions as F

from sieveline import And, FacetRange, Or, Range, RangeFacet, RangeValue, SearchRequest, SortField, Term, TermFacet, facets, search
from sieveline.sizing import staged
from sieveline.sources.documents import assemble, collect_specs, infer_fields
from sieveline.sources.variants import Path, json_documents, json_fields, rejected_lines, variant_paths, with_paths

from .registry import query, table


def part_lines(spark, sf):
    """``part`` as JSON lines: fields that only some have, numbers whole or not, nested values, broken lines."""
    key = F.col("p_partkey")
    record = F.struct(
        F.when(key % 13 != 0, key).alias("id"),
        F.col("p_name").alias("Name"),
        F.when(key % 10 != 0, F.col("p_size")).alias("Size"),
        F.split("p_name", " ").alias("Tags"),
        F.when(key % 3 == 0, F.col("p_type")).alias("Extra"),
        F.struct(
            F.col("p_brand").alias("brand"),
            F.struct(F.col("p_type").alias("kind"), (F.col("p_size") % 7).alias("grade")).alias("made of"),
            F.when(key % 2 == 0, F.array(key % 4, key % 5)).alias("codes"),
        ).alias("Details"),
    )
    # Fraction or whole number, by document.
    half = F.when(key % 2 == 0, F.concat((F.col("p_size") % 9).cast("string"), F.lit(".5"))).otherwise((F.col("p_size") % 9).cast("string"))
    whole = F.concat(F.expr("left(to_json(r), length(to_json(r)) - 1)"), F.lit(',"Half":'), half, F.lit("}"))
    line = F.when(key % 11 == 0, F.substring("whole", 1, 20)).when(key % 17 == 0, F.to_json(F.array("p_name"))).otherwise(F.col("whole"))
    return table(spark, sf, "part").withColumn("r", record).withColumn("whole", whole).select(line.alias("value"))


GOOD = "p_partkey % 11 <> 0 AND p_partkey % 17 <> 0 AND p_partkey % 13 <> 0"
GOOD_PARTS = f"(SELECT *, (p_size % 9) + CASE WHEN p_partkey % 2 = 0 THEN 0.5 ELSE 0 END::DOUBLE AS half FROM part WHERE {GOOD})"


@query(f"""SELECT p_partkey::VARCHAR AS __id, p_name AS name, CASE WHEN p_partkey % 10 <> 0 THEN p_size END::BIGINT AS size,
    replace(p_name, ' ', '|') AS tags, CASE WHEN p_partkey % 3 = 0 THEN p_type END AS extra, half::DOUBLE AS half, p_brand AS brand
    FROM {GOOD_PARTS}""")
def json_lines_documents(spark, sf):
    long = json_documents(part_lines(spark, sf))
    wide = with_paths(assemble(long, collect_specs(infer_fields(long))), [Path("brand", "details", "$.brand")])
    return wide.select("__id", "name", "size", F.array_join("tags", "|").alias("tags"), "extra", "half", "brand")


@query(f"""SELECT name, type, name = 'Tags' AS collection, count(*) AS documents FROM (
      SELECT unnest(['Name', 'Tags', 'Details', 'Half']) AS name, unnest(['String', 'String', 'Variant', 'Double']) AS type FROM {GOOD_PARTS}
      UNION ALL SELECT 'Size', 'Long' FROM {GOOD_PARTS} WHERE p_partkey % 10 <> 0
      UNION ALL SELECT 'Extra', 'String' FROM {GOOD_PARTS} WHERE p_partkey % 3 = 0) GROUP BY ALL""")
def json_line_fields(spark, sf):
    return json_fields(part_lines(spark, sf)).drop("json_type")


@query("""SELECT CASE WHEN p_partkey % 11 = 0 THEN 'no JSON' WHEN p_partkey % 17 = 0 THEN 'no object' ELSE 'no id' END AS reason, count(*) AS n
    FROM part WHERE p_partkey % 11 = 0 OR p_partkey % 17 = 0 OR p_partkey % 13 = 0 GROUP BY ALL""")
def json_lines_rejected(spark, sf):
    return rejected_lines(part_lines(spark, sf)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def part_details(spark, sf):
    """Documents with one complex field, written once, as a table of documents would be."""
    long = json_documents(part_lines(spark, sf))
    return staged(assemble(long, collect_specs(infer_fields(long))).drop("__seq"), "details")


PATHS = [
    Path("brand", "details", "$.brand"),
    Path("kind", "details", "$['made of'].kind"),
    Path("grade", "details", "$['made of'].grade", "bigint"),
    Path("code", "details", "$.codes[1]", "bigint"),
]


@query(f"""SELECT p_partkey::VARCHAR AS id, p_brand AS brand, (p_size % 7)::BIGINT AS grade,
      CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 5 END::BIGINT AS code FROM {GOOD_PARTS}
    WHERE p_size % 7 BETWEEN 2 AND 5 AND (p_brand IN ('Brand#1', 'Brand#12') OR (p_partkey % 2 = 0 AND p_partkey % 5 = 3))
    ORDER BY p_size % 7 DESC, p_partkey::VARCHAR LIMIT 50""")
def variant_filter_sort(spark, sf):
    request = SearchRequest(
        filter=And([Range("grade", [RangeValue("2", "5", True, True)]), Or([Term("brand", ["Brand#1", "Brand#12"]), Term("code", ["3"])])]),
        sort=[SortField("grade", descending=True)],
        take=50,
    )
    return search(with_paths(part_details(spark, sf), PATHS), request).documents.select("id", "brand", "grade", "code")


@query(f"""SELECT 'brand' AS aggregation_id, p_brand AS value_id, count(*) AS count FROM {GOOD_PARTS} GROUP BY ALL
    UNION ALL SELECT 'kind', p_type, count(*) FROM {GOOD_PARTS} GROUP BY ALL
    UNION ALL SELECT 'grade', CASE WHEN p_size % 7 < 3 THEN 'low' ELSE 'high' END, count(*) FROM {GOOD_PARTS} GROUP BY ALL""")
def variant_facets(spark, sf):
    grades = RangeFacet("grade", [FacetRange("low", upper="3"), FacetRange("high", lower="3")])
    wanted = [TermFacet("brand", size=0), TermFacet("kind", size=0), grades]
    return facets(with_paths(part_details(spark, sf), PATHS), wanted).drop("agg_pos")


@query(f"""SELECT path, type, count(*) AS rows FROM (
      SELECT unnest(['$[''brand'']', '$[''made of''][''kind'']', '$[''made of''][''grade'']']) AS path, unnest(['string', 'string', 'bigint']) AS type
        FROM {GOOD_PARTS}
      UNION ALL SELECT '$[''codes'']', NULL FROM {GOOD_PARTS} WHERE p_partkey % 2 = 0) GROUP BY ALL""", name="variant_paths")
def paths_of_details(spark, sf):
    return variant_paths(part_details(spark, sf), "details").drop("json_type")
