"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from conftest import SF
from checks import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    clean = lambda v: None if pd.isna(v) else v.isoformat() if hasattr(v, "isoformat") else v
    return sorted((tuple(clean(v) for v in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, db, name):
    check = REGISTRY[name]
    found = check.run(spark, SF).toPandas()
    wanted = db.execute(check.sql).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)
