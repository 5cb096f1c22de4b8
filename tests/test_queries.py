"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences

# The text operators have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name in entry.oracles.oracle_sql()}
ORACLES = entry.oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
