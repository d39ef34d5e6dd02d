"""Sorting, paging, projection, geo distance."""

from pyspark.sql import functions as F

from sieveline import GeoSort, SortField, geo_distance, page, retrieve, sort, total_count, with_flags
from sieveline import KEY, Range, RangeValue, apply_filter
from sieveline.operators.sorting import sort_columns

from .registry import CUSTOMERS_SQL, customers_on_map, km_sql, query, table


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 20")
def sort_string(spark, sf):
    df = sort(table(spark, sf, "part"), [SortField("P_Name")], ["p_partkey"])
    return page(df, 0, 20).select("p_partkey", "p_name")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def sort_numeric_desc(spark, sf):
    df = sort(table(spark, sf, "orders"), [SortField("o_totalprice", True)], ["o_orderkey"])
    return page(df, 0, 20).select("o_orderkey", "o_totalprice")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
    ORDER BY l_quantity DESC, l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50""")
def sort_multi(spark, sf):
    keys = [SortField("l_quantity", True), SortField("l_extendedprice"), SortField("L_Quantity", True)]
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    df = page(sort(table(spark, sf, "lineitem"), keys, ties), 0, 50)
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name DESC, p_partkey LIMIT 15")
def sort_unknown_ignored(spark, sf):
    df = sort(table(spark, sf, "part"), [SortField("no such field"), SortField("p_name", True)], ["p_partkey"])
    return page(df, 0, 15).select("p_partkey", "p_name")


@query(f"""SELECT c_custkey, km FROM (SELECT c_custkey, round({km_sql(3.7, 14.3)}, 3) AS km FROM {CUSTOMERS_SQL})
    ORDER BY km, c_custkey LIMIT 20""")
def sort_geo(spark, sf):
    df = customers_on_map(spark, sf)
    near = page(sort(df, [GeoSort("Place", 3.7, 14.3)], ["c_custkey"]), 0, 20)
    return near.select("c_custkey", F.round(geo_distance(F.col("place"), 3.7, 14.3), 3).alias("km"))


@query(f"""SELECT c_custkey, km FROM (SELECT c_custkey, round({km_sql(3.7, 14.3)}, 3) AS km FROM {CUSTOMERS_SQL})
    ORDER BY km DESC, c_custkey LIMIT 20""")
def sort_geo_desc(spark, sf):
    df = customers_on_map(spark, sf)
    far = page(sort(df, [GeoSort("Place", 3.7, 14.3, True)], ["c_custkey"]), 0, 20)
    return far.select("c_custkey", F.round(geo_distance(F.col("place"), 3.7, 14.3), 3).alias("km"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 40")
def page_skip_take(spark, sf):
    df = sort(table(spark, sf, "orders"), [SortField("o_orderkey")], ["o_orderkey"])
    return page(df, 40, 10).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey OFFSET 40")
def page_skip_only(spark, sf):
    df = table(spark, sf, "orders")
    order = [*sort_columns([SortField("o_totalprice")], df.schema), F.col("o_orderkey").asc()]
    return page(df, 40, None, order).select("o_orderkey", "o_totalprice")


@query("SELECT count(*) AS total FROM orders WHERE o_totalprice > 300000", name="total_count")
def total_count_of_matches(spark, sf):
    return total_count(apply_filter(table(spark, sf, "orders"), Range("o_totalprice", [RangeValue("300000")])))


@query("SELECT c_custkey::VARCHAR AS id, c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def project_retrievable(spark, sf):
    return retrieve(with_flags(table(spark, sf, "customer"), "c_acctbal", retrievable=False))


@query("SELECT event_id::VARCHAR AS id, ts, event_type FROM events")
def project_utc(spark, sf):
    df = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return retrieve(df.select(KEY, "ts", "event_type"))


@query(f"SELECT c_custkey, round({km_sql(48.5, -120.25)}, 3) AS km FROM {CUSTOMERS_SQL}")
def geo_distance_km(spark, sf):
    df = customers_on_map(spark, sf)
    return df.select("c_custkey", F.round(geo_distance(F.col("place"), 48.5, -120.25), 3).alias("km"))
