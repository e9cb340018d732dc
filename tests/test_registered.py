"""Every registered query against its SQL on the smallest data set."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.all_queries(), registry.all_oracles()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert sum(row.number_of_queries for row in entry.entry(spark).collect()) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) is None
