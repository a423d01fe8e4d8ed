"""Every registered query against its SQL on the small generated tables."""

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no generated tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_registry_and_sql_hold_the_same_names():
    assert set(entry.own_queries()) <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.own_queries()))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name, entry.own_queries()[name], SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
