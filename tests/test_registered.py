"""Every registered query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.compare import EMPTY, compare, database
from workload.oracles import ORACLES
from workload.queries import QUERIES

# Needs wedges or markers, which the smallest data has none of.
MAY_BE_EMPTY = {"d7_wedges", "d8_replay_set"}


@pytest.fixture(scope="module")
def connection(sf):
    return database(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, sf, name):
    problem = compare(spark, connection, entry.queries()[name], entry.oracle_sql()[name], sf)
    if name in MAY_BE_EMPTY and problem == EMPTY:
        problem = None
    assert problem is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
