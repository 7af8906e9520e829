"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from workload.check import compare, connect
from workload.oracle import SQL
from workload.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["noted_date", "temp"]
    assert df.count() > 0
