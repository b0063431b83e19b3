"""Registered queries of the training-data operators against their SQL, at the smallest scale."""

import os

import pytest

from compare import compare, oracle
from sitefold.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], FOLDER) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
