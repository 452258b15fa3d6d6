"""Every registered query against its SQL: names, types, rows and values."""

import os
from pathlib import Path

import pytest
from compare import connect, spark_result, sql_result

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The training-data queries have tests of their own beside them.
QUERIES = {n: q for n, q in entry_point.queries().items() if n not in entry_point.LLM_QUERIES}
SQL = {n: s for n, s in entry_point.oracle_sql().items() if n not in entry_point.LLM_SQL}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    types, rows = spark_result(QUERIES[name](spark, SF_DIR))
    sql_types, sql_rows = sql_result(con, SQL[name])
    assert types == sql_types
    assert rows == sql_rows
    assert rows


def test_entry_is_the_flagship(spark):
    assert entry_point.entry(spark).columns == ["transaction_type", "record_count", "total_amount", "pct_of_total"]
