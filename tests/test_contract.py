"""Every registered query runs, and equals its SQL where it has one."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, differences

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return connection


def test_entry(spark):
    assert contract.entry(spark).count() == 5


def test_every_statement_has_a_query():
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, small, name):
    ours = contract.queries()[name](spark, small).toPandas()
    assert len(ours) > 0
    if name in SQL:
        assert differences(ours, duck.execute(SQL[name]).df()) == ""
