"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next.

Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm import curriculum, decontaminate, hash_tree, language, ngram_join
from sieveline.llm.common import set_aside
from sieveline.sizing import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; what the models reject goes."""
    rows, columns = set_aside(docs, "text")
    return language.identify(rows, language.fit_on(docs)).filter("not rejected").select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    rows, columns = set_aside(docs, "doc_id", "source", "text")
    return curriculum.training_order(curriculum.mix_sources(rows)).select(*columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their place in 24 shards."""
    return hash_tree.shard_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Character models are trained and applied in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
