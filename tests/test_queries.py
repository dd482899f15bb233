"""Every registered query of the core against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from dialogue_etl import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()
TABLES = ["documents", "pages", "conversations", "events"]


def rows(frame: pd.DataFrame) -> list[str]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(str([None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r]) for r in frame.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, con):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert name in SQL
    want = con.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    assert len(got)
