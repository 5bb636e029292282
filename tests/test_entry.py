"""Driver contract, and every registered query against its oracle on sf0.001."""

import importlib
from pathlib import Path

import duckdb

import pytest

from conftest import SF
from tools.oracle_check import rows_of


def test_entry_contract(spark):
    e = importlib.import_module("__spark_entry__")
    df = e.entry(spark)
    assert df.count() > 0
    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 40


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


E = importlib.import_module("__spark_entry__")
# the corpus operators have tests of their own
OWN = [n for n, q in sorted(E.load_all().items()) if not q.build.__module__.startswith("parley.llm")]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_oracle(spark, duck, name):
    """Every column of every query on sf0.001, where many inputs are empty or unmatched."""
    got = E.queries()[name](spark, SF).toPandas()
    assert len(got.columns) > 0
    sql = E.oracle_sql().get(name)
    if sql is not None:
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
