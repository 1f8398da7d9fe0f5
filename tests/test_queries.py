"""Every registered query with an SQL form gives the same rows as DuckDB."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check import compare

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return con


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(contract.queries())
    assert {q.__name__ for q in contract._QUERIES} - set(SQL) == {"predictions"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, sf_dir, db):
    got = contract.queries()[name](spark, sf_dir).toPandas()
    assert compare(got, db.execute(SQL[name]).df()) == ""


def test_entry_has_the_107_columns(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 107
    assert df.count() > 0
