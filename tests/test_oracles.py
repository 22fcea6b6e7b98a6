"""Every catalogue query against its SQL twin on another engine."""

import pytest

import __spark_entry__ as entry_point
from check import compare, oracle_connection
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def connection(medium):
    return oracle_connection(medium)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, connection, medium, name):
    assert compare(spark, connection, medium, name) == ""


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 261
