"""Every query with SQL against DuckDB over the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from acervo.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def rows(df, columns):
    return sorted((tuple("" if pd.isna(v) else round(float(v), 9) if isinstance(v, int | float) else str(v) for v in r) for r in df[columns].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))
