"""Every registered query against its SQL, on the smallest shared tables."""

import pytest
from check_queries import database, differences

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
QUERIES, CHECKS = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_as_sql(spark, con, name):
    assert differences(spark, con, FOLDER, name, QUERIES[name], CHECKS[name]).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
