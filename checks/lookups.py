"""Places by cells and completions by prefixes, each from a table written once."""

from functools import reduce

from pyspark.sql import functions as F

from sieveline import with_flags
from sieveline.functions.geo import haversine_km
from sieveline.operators.completions import complete, completion_pairs, completions, merge_completions
from sieveline.operators.nearby import nearest, with_cells, within
from sieveline.sizing import staged

from .registry import CUSTOMERS_SQL, customers_on_map, hits_sql, km_sql, query, table

LAT, LON = "place_lat", "place_lon"
# Inland, at the date line, at a pole.
SPOTS = [(3.7, 14.3, 2500.0), (10.0, 179.0, 3000.0), (-88.0, 20.0, 2500.0)]


def on_cells(spark, sf):
    return staged(with_cells(customers_on_map(spark, sf), LAT, LON), "cells")


def circle_sql(n: int) -> str:
    lat, lon, km = SPOTS[n]
    return f"SELECT {n} AS spot, c_custkey, round({km_sql(lat, lon)}, 3) AS km FROM {CUSTOMERS_SQL} WHERE {km_sql(lat, lon)} <= {km}"


@query(" UNION ALL ".join(circle_sql(n) for n in range(3)))
def geo_within_cells(spark, sf):
    df = on_cells(spark, sf)
    from_spot = lambda n, lat, lon, km: within(df, LAT, LON, lat, lon, km).select(
        F.lit(n).alias("spot"), "c_custkey", F.round(haversine_km(F.col(LAT), F.col(LON), lat, lon), 3).alias("km")
    )
    return reduce(lambda a, b: a.unionByName(b), [from_spot(n, *spot) for n, spot in enumerate(SPOTS)])


def nearest_sql(n: int) -> str:
    lat, lon, _ = SPOTS[n]
    return f"""(SELECT {n} AS spot, c_custkey, round({km_sql(lat, lon)}, 3) AS km FROM {CUSTOMERS_SQL}
        ORDER BY round({km_sql(lat, lon)}, 3), c_custkey LIMIT 15)"""


@query(" UNION ALL ".join(nearest_sql(n) for n in range(3)))
def geo_nearest(spark, sf):
    df = on_cells(spark, sf)
    found = [
        nearest(df, LAT, LON, lat, lon, 15, ["c_custkey"]).select(F.lit(n).alias("spot"), "c_custkey", F.round("km", 3).alias("km"))
        for n, (lat, lon, _) in enumerate(SPOTS)
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


TYPED = ["wid", "Red g", "g", "steel red b"]


def typed_sql(typed: str) -> str:
    *before, last = typed.lower().split()
    tests = [f"{hits_sql('p_name', f"x = '{t}'")} > 0" for t in before] + [f"{hits_sql('p_name', f"starts_with(x, '{last}')")} > 0"]
    return f"(SELECT DISTINCT '{typed}' AS typed, p_name AS text FROM part WHERE {' AND '.join(tests)} ORDER BY p_name LIMIT 5)"


@query(" UNION ALL ".join(map(typed_sql, TYPED)))
def suggest_completions(spark, sf):
    parts = with_flags(table(spark, sf, "part"), "p_name", suggestable=True)
    early, late = (completion_pairs(parts.filter(F.col("p_partkey") % 2 == r), ["p_name"]) for r in (0, 1))
    # The completions of two halves together: as if the second half had come later.
    prefixes = staged(merge_completions(completions(early), completions(late)), "completions")
    pairs = staged(completion_pairs(parts, ["p_name"]).sort("prefix"), "completion-pairs")
    found = [complete(prefixes, pairs, q).select(F.lit(q).alias("typed"), "text") for q in TYPED]
    return reduce(lambda a, b: a.unionByName(b), found)
