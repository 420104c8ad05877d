"""Every registered query against its SQL on the smallest given tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import compare

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def lake():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, lake, name):
    result = contract.queries()[name](spark, SF_DIR)
    got = result.toPandas()
    assert len(got.columns) > 0 and result.count() == len(got)
    if name in SQL:
        assert compare(got, lake.sql(SQL[name]).df()) == ""
    else:
        assert len(got) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_sql_names_are_registered():
    assert set(SQL) <= set(contract.queries())
