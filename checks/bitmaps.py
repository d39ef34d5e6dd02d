"""Facets under several filters, counted from bitmaps written once."""

from pyspark.sql import functions as F

from sieveline.operators.bitmaps import BitmapFacet, bitmap_facets, facet_bitmaps, merge_bitmaps, numbered, selected_total
from sieveline.sizing import staged

from .registry import query, table

FIELDS = ["p_brand", "p_type", "p_size", "tags"]


def part_bitmaps(spark, sf):
    """Bitmaps of two halves of the rows, put together."""
    part = table(spark, sf, "part").withColumn("tags", F.split("p_name", " "))
    rows = numbered(part, FIELDS)
    early, late = (facet_bitmaps(rows.filter(F.col("__row") % 2 == r), FIELDS) for r in (0, 1))
    return staged(merge_bitmaps(early, late).sort("field", "value"), "bitmaps")


SMALL = [str(n) for n in range(1, 16)]
BRANDS = ["Brand#3", "Brand#14", "Brand#25"]
SMALL_SQL, BRANDS_SQL = "p_size BETWEEN 1 AND 15", "p_brand IN ('Brand#3', 'Brand#14', 'Brand#25')"


@query(f"""SELECT 'brand' AS aggregation_id, p_brand AS value_id, count(*) AS count FROM part WHERE {SMALL_SQL} GROUP BY ALL
    UNION ALL SELECT 'p_type', p_type, count(*) FROM part WHERE {SMALL_SQL} AND {BRANDS_SQL} GROUP BY ALL
    UNION ALL SELECT 'p_size', p_size::VARCHAR, count(*) FROM part GROUP BY ALL
    UNION ALL SELECT 'tags', tag, count(*) FROM (SELECT unnest(list_distinct(string_split(p_name, ' '))) AS tag FROM part
        WHERE {BRANDS_SQL} AND list_contains(string_split(p_name, ' '), 'red')) GROUP BY ALL""")
def facet_by_bitmaps(spark, sf):
    wanted = [
        BitmapFacet("P_Brand", "brand", {"p_size": SMALL}),
        BitmapFacet("p_type", where={"p_size": SMALL, "p_brand": BRANDS}),
        BitmapFacet("p_size"),
        BitmapFacet("tags", where={"P_Brand": BRANDS, "tags": ["red"]}),
    ]
    return bitmap_facets(part_bitmaps(spark, sf), wanted).drop("agg_pos")


@query(f"SELECT count(*) AS total FROM part WHERE {SMALL_SQL} AND {BRANDS_SQL}")
def total_by_bitmaps(spark, sf):
    return selected_total(part_bitmaps(spark, sf), {"p_size": SMALL, "p_brand": BRANDS})
