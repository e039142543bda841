"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.compare import rows_of

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["cal_date", "category", "revenue"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.collect(), df.columns)
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(result.fetchall(), columns)
