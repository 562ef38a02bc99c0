"""Every registered query with an oracle, on the smallest driver tables."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from workload.check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_its_oracle(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_oracles_name_registered_queries():
    assert set(oracle_sql()) <= set(queries())
