"""Every registered query against its SQL; ``CHECK_SF_DIR`` names the tables."""

import os

import pytest
from oracle import connect, spark_rows, sql_rows

from __spark_entry__ import oracle_sql, queries

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, con, name):
    columns, got = spark_rows(queries()[name](spark, FOLDER))
    names, expected = sql_rows(con, oracle_sql()[name])
    assert columns == names
    assert len(got) == len(expected)
    assert got == expected
