"""The operators' queries over the smallest tables: SQL where there is some, and a row for every document."""

import os

import duckdb
import pandas as pd
import pytest

from acervo.llm import registry

SF = "/root/testdata/sf0.001"


def rows(df, columns):
    return sorted((tuple("" if pd.isna(v) else round(float(v), 9) if isinstance(v, int | float) else str(v) for v in r) for r in df[columns].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    got, want = registry.queries()[name](spark, SF).toPandas(), c.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


#: Its rows are groups, not documents.
AUDITS = {"op12_source_divergence", "op13_filter_interaction"}


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - AUDITS))
def test_every_document_has_a_row(spark, name):
    got = registry.queries()[name](spark, SF)
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == ids


def test_registry_names_all():
    assert [int(n[2:].split("_")[0]) for n in registry.queries()] == list(range(1, 14))
