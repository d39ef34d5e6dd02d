"""The registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
import __spark_entry__ as entry
from sieveline.llm.queries import ORACLE_SQL, QUERIES
from conftest import SF
from rows import clashing, empty_docs, odd_rows

TABLES = "documents benchmark pages conversations"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    found = QUERIES[name](spark, SF).toPandas()
    assert len(found)
    if name in ORACLE_SQL:
        wanted = db.execute(ORACLE_SQL[name]).df()
        assert sorted(found.columns) == sorted(wanted.columns) and rows(found) == rows(wanted)


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_pipeline_stages(spark):
    from sieveline.llm import curriculum, decontaminate, language, ngram_join

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, SF)
    rejected = {r.doc_id for r in language.identify(docs, language.fit_on(docs)).filter("rejected").collect()}
    ids = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in kept.collect()} == ids - rejected and kept.columns == docs.columns
    stays = {r.doc_id for r in ngram_join.jaccard_components(kept).collect() if r.doc_id == r.component_id}
    single = stages["near_duplicates"](spark, kept, SF)
    assert {r.doc_id for r in single.collect()} == stays and single.columns == docs.columns
    leaks = {r.doc_id for r in decontaminate.find_leaks(single, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    clean = stages["decontamination"](spark, single, SF)
    assert leaks and {r.doc_id for r in clean.collect()} == stays - leaks and clean.columns == docs.columns
    mixed = stages["mixing"](spark, clean, SF)
    copies = {r.doc_id: r.copies for r in curriculum.mix_sources(clean).collect()}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {i: n for i, n in copies.items() if n} and mixed.columns == docs.columns
    final = stages["sharding"](spark, mixed, SF).collect()
    assert len(final) == sum(got.values()) and {r.shard for r in final} <= set(range(24))
    assert corpus_pipeline.run(spark, SF).count() == len(final)


@pytest.mark.parametrize("make", [clashing, empty_docs])
def test_pipeline_on_odd_rows(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() <= 3 * len(odd_rows())
