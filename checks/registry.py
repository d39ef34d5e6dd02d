from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sieveline import KEY
from sieveline.functions.geo import geo_point
from sieveline.sources.documents import FieldOf, to_long, with_key


@dataclass(frozen=True)
class Check:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Check] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register the function under its name, with the SQL that gives the same rows."""

    def register(run):
        key = name or run.__name__
        REGISTRY[key] = Check(key, run, sql)
        return run

    return register


# Key column of each table that queries use as a document table.
KEYS = {
    "part": "p_partkey",
    "orders": "o_orderkey",
    "customer": "c_custkey",
    "documents": "doc_id",
    "events": "event_id",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; those with a single-column key get it as ``__id`` too."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return with_key(df, KEYS[name]) if name in KEYS else df


def size_with_nulls(df: DataFrame) -> DataFrame:
    """The given tables have no nulls: make some."""
    return df.withColumn("size_n", F.when(F.col("p_size") % 10 != 0, F.col("p_size")))


SIZE_N_SQL = "(SELECT *, CASE WHEN p_size % 10 <> 0 THEN p_size END AS size_n FROM part)"


def customers_on_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with coordinates derived from the key: as two columns and as a point."""
    df = table(spark, sf_dir, "customer")
    lat = (F.col("c_custkey") * 7 % 181 - 90).cast("double")
    lon = (F.col("c_custkey") * 13 % 361 - 180).cast("double")
    return df.withColumns({"place_lat": lat, "place_lon": lon, "place": geo_point(lat, lon)})


CUSTOMERS_SQL = """(SELECT *, (c_custkey * 7 % 181 - 90)::DOUBLE AS place_lat,
    (c_custkey * 13 % 361 - 180)::DOUBLE AS place_lon FROM customer)"""


def km_sql(lat: float, lon: float) -> str:
    return f"""(2 * 6371.0088 * asin(sqrt(least(1.0,
        pow(sin(radians(place_lat - ({lat})) / 2), 2)
        + cos(radians(place_lat)) * cos(radians({lat}))
          * pow(sin(radians(place_lon - ({lon})) / 2), 2)))))"""


def tokens_sql(column: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '')"
    )


def hits_sql(column: str, test: str) -> str:
    """Number of tokens of a text column that pass a test over ``x``."""
    return f"len(list_filter({tokens_sql(column)}, lambda x: {test}))"


# Letters with apostrophes, colons or stops between, digits with commas or stops between, joined with underscores.
LETTERS_RE = r"[\p{Latin}\p{Greek}\p{Cyrillic}\p{Lm}]\p{M}*"
STANDARD_RE = (
    rf"_*(?:(?:{LETTERS_RE})+(?:[:·''.‘’](?:{LETTERS_RE})+)*|\p{{Nd}}+(?:[,;''.‘’]\p{{Nd}}+)*)+"
    rf"(?:_+(?:(?:{LETTERS_RE})+(?:[:·''.‘’](?:{LETTERS_RE})+)*|\p{{Nd}}+(?:[,;''.‘’]\p{{Nd}}+)*)+)*_*|\p{{Han}}|\p{{Hiragana}}"
)


def standard_sql(text: str) -> str:
    """Tokens of a text by the standard tokenizer, for the scripts of the given tables and ideographs."""
    return f"regexp_extract_all(lower({text}), '{STANDARD_RE}')"


def one(column: str) -> Column:
    return F.array(F.col(column).cast("string"))


def part_fields(**more: FieldOf) -> dict[str, FieldOf]:
    return {
        "Name": FieldOf(one("p_name"), searchable=True, suggestable=True),
        "Brand": FieldOf(one("p_brand")),
        "Size": FieldOf(one("p_size"), "Integer"),
        "Price": FieldOf(one("p_retailprice"), "Decimal"),
        "Tags": FieldOf(F.split("p_name", " "), collection=True),
        **more,
    }


def part_long(spark: SparkSession, sf_dir: str, fields: dict[str, FieldOf] | None = None) -> DataFrame:
    """``part`` as long-form documents, one row per field."""
    df = table(spark, sf_dir, "part")
    return to_long(df, F.col("p_partkey"), F.col("p_partkey"), fields or part_fields())
