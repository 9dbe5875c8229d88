"""Every catalogued query against its DuckDB oracle at sf0.001, and the entry smoke check."""

import duckdb
import pytest

import __spark_entry__ as E
from oracle_check import TABLES, table_hash
from conftest import SF_SMALL

SQL = E.oracle_sql()
OWN = sorted(set(E.queries()) - set(E.LLM_QUERIES))  # the training-data operators are tested in tests/llm


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["day", "days_ago", "segment"]
    assert df.count() == 21


def test_every_query_has_oracle():
    assert set(OWN) <= set(SQL)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(want)
    assert table_hash(df.columns, rows) == table_hash(cols, want)
