"""Every registered query against its DuckDB oracle at sf0.01 (what the
driver's correctness gate does), plus the entry smoke check."""

import duckdb
import pytest

from conftest import SF001, SF01

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "anio"


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF01).toPandas()
    exp = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert rows_of(got) == rows_of(exp)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF001).count() >= 0
