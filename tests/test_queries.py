"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SLOW = ("mdl", "tun", "enc10", "snk2", "str1", "spl9", "txt10")
CHECKED = sorted(n for n in entry.queries() if n in entry.oracle_sql())
UNCHECKED = sorted(n for n in entry.queries() if n not in entry.oracle_sql() and not n.startswith(("mdl", "tun")))


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", CHECKED)
def test_same_rows_as_sql(spark, sf, con, name):
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], sf)
    spark.catalog.clearCache()
    assert res.startswith("ok"), res


@pytest.mark.parametrize("name", UNCHECKED)
def test_runs(spark, sf, con, name):
    res = compare(spark, con, name, entry.queries()[name], None, sf)
    spark.catalog.clearCache()
    assert res.startswith("rows-only"), res


def test_no_sql_without_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
