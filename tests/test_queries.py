"""Every registered query against its SQL statement on the test tables."""

from __future__ import annotations

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from featurekit.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    assert compare(QUERIES[name](spark, sf_dir), ORACLES[name], connection) == []


def test_every_feature_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    result = entry(spark)
    assert result.columns[0] == "o_orderkey"
    assert result.count() > 0
