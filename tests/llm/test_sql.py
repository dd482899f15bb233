"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from dialogue_etl.llm import registry

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    frames = [f[sorted(f.columns)].astype(object) for f in (registry.queries()[name](spark, sf_dir).toPandas(), con.sql(SQL[name]).df())]
    got, want = (sorted(str([None if pd.isna(v) else v for v in r]) for r in f.itertuples(index=False, name=None)) for f in frames)
    assert list(frames[0].columns) == list(frames[1].columns)
    assert got == want
