"""Every named query against its SQL on the driver tables."""

import os

import pytest

import __spark_entry__ as spark_entry
from streamtally import plans
from tests.compare import oracle_connection, oracle_rows, spark_rows, type_differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = plans.queries(), plans.oracles()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    assert type_differences(frame, con, ORACLES[name]) == []
    assert spark_rows(frame) == oracle_rows(con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_random_queries_run(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    assert 0 < frame.count() <= 100


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
