"""Every registered query against its SQL."""

import compare
import pytest

import __spark_entry__ as entry
from footfall.catalog.oracle import oracles
from footfall.catalog.queries import all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, con, name):
    error = compare.compare(spark, con, name, all_queries()[name], oracles().get(name), SF)
    assert error is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 1
