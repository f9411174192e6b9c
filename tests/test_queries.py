"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    if name not in SQL:
        assert rows
        return
    cursor = con.execute(SQL[name])
    assert compare(rows, df.columns, cursor.fetchall(), [c[0] for c in cursor.description]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) >= 140
