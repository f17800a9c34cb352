"""Every catalog query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as contract
from tokenloom.catalog import ENTRIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query_equals_sql(spark, db, name):
    sql = contract.oracle_sql().get(name)
    result = spark_rows(contract.queries()[name](spark, FOLDER))
    if sql:
        assert result == sql_rows(db, sql)


def test_entry(spark):
    totals = {r["lang"]: r["n_tokens"] for r in contract.entry(spark).collect()}
    assert sum(totals.values()) == 283_261
