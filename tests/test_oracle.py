"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, oracle
from driver_oracle import ORACLE
from driver_queries import QUERIES

FOLDER = os.environ.get("SITEFOLD_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, name, queries()[name], oracle_sql()[name], FOLDER)
    assert problem in (None, "no rows"), problem


def test_entry(spark):
    assert entry(spark).count() > 0
