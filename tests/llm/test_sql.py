"""Queries with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from scriptmill.llm import line_frequency, queries

SF = "/root/testdata/sf0.001"


def same(got, want):
    cols = sorted(got.columns)
    rows = lambda df: sorted(map(str, df[cols].astype(object).values.tolist()))
    assert cols == sorted(want.columns) and rows(got) == rows(want)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, duck, name):
    same(queries.QUERIES[name](spark, SF).toPandas(), duck.sql(queries.SQL[name]).df())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_low_limits(spark, duck):
    """With limits that the small tables reach."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "'h' AS source", "text")
    got = line_frequency.quality_rules(docs, min_docs=1, share=0.0, max_removed=0.3).toPandas()
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT doc_id, 'h' AS source, text FROM '{SF}/documents.parquet'")
    same(got, c.sql(line_frequency.op1_sql(min_docs=1, share=0.0, max_removed=0.3)).df())
    assert got.n_removed_lines.sum() > 0
