"""Every registered query with a SQL twin agrees with it."""

import pytest
from oracle import compare, connect

from gleaner.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees(spark, connection, name):
    assert compare(spark, connection, QUERIES[name], ORACLES[name], FOLDER) is None


def test_names():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
