"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from check import compare, duck
from jobsignal.plans.catalog import CATALOG

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(CATALOG) <= set(ORACLE) <= set(QUERIES) and len(CATALOG) > 85


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
