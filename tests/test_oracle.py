"""Every registered query against its DuckDB SQL, to the last digit."""

import os

import pytest

import __spark_entry__ as contract
from verification import oracle
from verification.compare import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

SQL = oracle.build()
QUERIES = {name: query for name, query in contract.queries().items() if name in SQL}


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as con:
        yield con


def test_every_query_has_sql():
    named = {name for name in contract.queries() if not name.startswith("op") and name != "pipeline"}
    assert named == set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert differences(spark, duck, SF_DIR, QUERIES[name], SQL[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 6
