"""Filters."""

from pyspark.sql import functions as F

from sieveline import And, GeoDistance, Ids, Not, Or, Range, RangeValue, RawFilter, Term, apply_filter
from sieveline.operators.filters import filter_by_keys

from .registry import CUSTOMERS_SQL, SIZE_N_SQL, customers_on_map, km_sql, query, size_with_nulls, table

PART = ["p_partkey", "p_name", "p_brand", "p_size"]
PART_SQL = "p_partkey, p_name, p_brand, p_size"


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 5, 77, 1234, 99999999)")
def filter_ids(spark, sf):
    df = apply_filter(table(spark, sf, "orders"), Ids(["1", "5", "77", "1234", "99999999", ""]))
    return df.select("o_orderkey", "o_totalprice")


@query("""SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def filter_ids_from_table(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    keys = returned.select(F.col("l_orderkey").alias("o_orderkey"))
    return filter_by_keys(table(spark, sf, "orders"), keys, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_term_string(spark, sf):
    df = apply_filter(table(spark, sf, "customer"), Term("C_MktSegment", ["BUILDING", "MACHINERY", "", None]))
    return df.select("c_custkey", "c_mktsegment")


@query(f"SELECT {PART_SQL} FROM part WHERE p_size IN (1, 2, 3)")
def filter_term_int(spark, sf):
    return apply_filter(table(spark, sf, "part"), Term("p_size", ["1", "2", "3"])).select(PART)


@query("""SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate IN (TIMESTAMP '1998-10-03', TIMESTAMP '1997-05-28', TIMESTAMP '2001-01-01')""")
def filter_term_date(spark, sf):
    days = ["1998-10-03T00:00:00Z", "1997-05-28T02:00:00+02:00", "2001-01-01T00:00:00.000Z"]
    return apply_filter(table(spark, sf, "orders"), Term("o_orderdate", days)).select("o_orderkey", "o_orderdate")


@query("SELECT p_partkey, p_name FROM part WHERE list_has_any(string_split(p_name, ' '), ['red', 'gear'])")
def filter_term_collection(spark, sf):
    df = table(spark, sf, "part").withColumn("tags", F.split("p_name", " "))
    return apply_filter(df, Term("Tags", ["red", "gear"])).select("p_partkey", "p_name")


@query("SELECT o_orderkey, o_totalprice > 200000 AS is_big FROM orders WHERE o_totalprice > 200000")
def filter_boolean(spark, sf):
    df = table(spark, sf, "orders").withColumn("is_big", F.col("o_totalprice") > 200000)
    return apply_filter(df, Term("Is Big", ["tRue"])).select("o_orderkey", "is_big")


@query(f"SELECT {PART_SQL} FROM part WHERE p_size > 0 AND p_size < 4")
def filter_range_numeric(spark, sf):
    return apply_filter(table(spark, sf, "part"), Range("p_size", [RangeValue("0", "4")])).select(PART)


@query(f"SELECT {PART_SQL} FROM part WHERE p_size < 4 OR (p_size >= 10 AND p_size <= 12)")
def filter_range_multi(spark, sf):
    values = [RangeValue("", "4"), RangeValue("10", "12", True, True), RangeValue(None, "")]
    return apply_filter(table(spark, sf, "part"), Range("p_size", values)).select(PART)


def priced(spark, sf):
    """Orders with their price as a decimal with two places."""
    return table(spark, sf, "orders").withColumn("price", F.round("o_totalprice", 2).cast("decimal(12,2)"))


@query("""SELECT o_orderkey FROM orders WHERE round(o_totalprice, 2)::DECIMAL(12,2) > 150000.005
    AND round(o_totalprice, 2)::DECIMAL(12,2) <= 200000.50""")
def filter_range_decimal(spark, sf):
    return apply_filter(priced(spark, sf), Range("price", [RangeValue("150000.005", "200000.5", False, True)])).select("o_orderkey")


@query("""SELECT o_orderkey FROM orders WHERE round(o_totalprice, 2)::DECIMAL(12,2) IN
    (SELECT round(o_totalprice, 2)::DECIMAL(12,2) FROM orders WHERE o_orderkey = 1)""")
def filter_term_decimal(spark, sf):
    df = priced(spark, sf)
    price = df.filter("o_orderkey = 1").first()["price"]
    return apply_filter(df, Term("price", [f"{price}000", f"{price}5"])).select("o_orderkey")


@query(f"SELECT {PART_SQL} FROM part WHERE (p_size > 3.5 AND p_size <= 9.2) OR (p_size >= 20.1 AND p_size < 22.9)")
def filter_range_fraction(spark, sf):
    values = [RangeValue("3.5", "9.2", False, True), RangeValue("20.1", "22.9", True)]
    return apply_filter(table(spark, sf, "part"), Range("p_size", values)).select(PART)


@query("""SELECT o_orderkey, o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1998-10-03' AS closed,
      o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1998-10-03' AS left_open,
      o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-10-03' AS right_open,
      o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-10-03' AS open
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1998-10-03'""")
def filter_range_date(spark, sf):
    from sieveline import to_column

    df = table(spark, sf, "orders")
    low, high = "1997-01-01T00:00:00Z", "1998-10-03T00:00:00Z"
    kinds = {"closed": (True, True), "left_open": (False, True), "right_open": (True, False), "open": (False, False)}
    columns = {
        name: to_column(Range("o_orderdate", [RangeValue(low, high, *kind)]), df.schema) for name, kind in kinds.items()
    }
    return df.filter(columns["closed"]).select("o_orderkey", *[c.alias(n) for n, c in columns.items()])


@query(f"SELECT c_custkey, round({km_sql(0, 14)}, 3) AS km FROM {CUSTOMERS_SQL} WHERE {km_sql(0, 14)} <= 1110")
def filter_geo_distance(spark, sf):
    from sieveline.functions.geo import haversine_km

    df = apply_filter(customers_on_map(spark, sf).drop("place"), GeoDistance("place", 0, 14, 1110))
    return df.select("c_custkey", F.round(haversine_km(F.col("place_lat"), F.col("place_lon"), 0, 14), 3).alias("km"))


@query(f"SELECT c_custkey FROM {CUSTOMERS_SQL} WHERE NOT {km_sql(60, -170)} <= 4000")
def filter_geo_distance_point(spark, sf):
    return apply_filter(customers_on_map(spark, sf), Not(GeoDistance("Place", 60, -170, 4000))).select("c_custkey")


@query(f"SELECT p_partkey, size_n FROM {SIZE_N_SQL} WHERE NOT coalesce(size_n IN (1, 2, 3), false)")
def filter_not_term(spark, sf):
    df = size_with_nulls(table(spark, sf, "part"))
    return apply_filter(df, Not(Term("size_n", ["1", "2", "3"]))).select("p_partkey", "size_n")


@query(f"""SELECT p_partkey, size_n FROM {SIZE_N_SQL}
    WHERE NOT coalesce((size_n > 0 AND size_n < 4) OR (size_n > 4 AND size_n < 20), false)""")
def filter_not_range(spark, sf):
    df = size_with_nulls(table(spark, sf, "part"))
    node = Not(Range("size_n", [RangeValue("0", "4"), RangeValue("4", "20")]))
    return apply_filter(df, node).select("p_partkey", "size_n")


BRANDS = ["Brand#1", "Brand#12", "Brand#25"]


@query(f"""SELECT {PART_SQL} FROM part
    WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#25') AND ((p_size > 0 AND p_size < 4) OR (p_size > 4 AND p_size <= 20))""")
def filter_and(spark, sf):
    sizes = Range("p_size", [RangeValue("0", "4"), RangeValue("4", "20", False, True)])
    return apply_filter(table(spark, sf, "part"), And([Term("p_brand", BRANDS), None, sizes])).select(PART)


@query(f"SELECT {PART_SQL} FROM part WHERE p_brand = 'Brand#12' OR p_size > 40")
def filter_or(spark, sf):
    node = Or([Term("p_brand", ["Brand#12"]), Range("p_size", [RangeValue("40")]), Ids([])])
    return apply_filter(table(spark, sf, "part"), node).select(PART)


@query(f"SELECT {PART_SQL} FROM part WHERE p_brand = 'Brand#1' OR (NOT p_brand = 'Brand#12' AND p_size < 20)")
def filter_nested(spark, sf):
    rest = And([Not(Term("p_brand", ["Brand#12"])), Range("p_size", [RangeValue(upper="20")])])
    return apply_filter(table(spark, sf, "part"), Or([Term("p_brand", ["Brand#1"]), rest])).select(PART)


@query(f"""SELECT p_partkey, size_n FROM {SIZE_N_SQL}
    WHERE NOT (coalesce(size_n < 30, false) AND NOT (p_brand = 'Brand#1' OR coalesce(size_n IN (4, 5), false)))""")
def filter_not_nested(spark, sf):
    df = size_with_nulls(table(spark, sf, "part"))
    inner = Not(Or([Term("p_brand", ["Brand#1"]), Term("size_n", ["4", "5"])]))
    node = Not(And([Range("size_n", [RangeValue(upper="30")]), inner]))
    return apply_filter(df, node).select("p_partkey", "size_n")


@query(f"SELECT {PART_SQL} FROM part WHERE false")
def filter_unknown_field(spark, sf):
    return apply_filter(table(spark, sf, "part"), Term("no such field", ["x"])).select(PART)


@query(f"SELECT {PART_SQL} FROM part WHERE p_size % 2 = 0 AND p_brand LIKE 'Brand#1%'")
def filter_raw_expr(spark, sf):
    return apply_filter(table(spark, sf, "part"), RawFilter("p_size % 2 = 0 AND p_brand LIKE 'Brand#1%'")).select(PART)
