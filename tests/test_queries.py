"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from verify import TABLES, compare

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for name in TABLES:
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIRECTORY}/{name}.parquet'")
    return made


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_matches_sql(spark, connection, name):
    text, good = compare(spark, connection, DIRECTORY, contract.queries()[name], contract.oracle_sql().get(name))
    assert good, text


def test_entry(spark):
    assert contract.entry(spark).count() > 0
