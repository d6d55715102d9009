"""Every registered query equals its SQL on the small tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from changeflow.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    problem = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert entry.entry(spark).limit(1).count() == 1
