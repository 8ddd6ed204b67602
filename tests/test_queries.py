"""Every registered query against its SQL on the small tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as spark_entry
from feedfold.plans import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registry.collect("QUERIES"), registry.collect("SQL")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = differences(spark, con, SF_DIR, QUERIES[name], SQL[name])
    assert problem is None, problem


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
