"""Every registered query that has an oracle against it; ORACLE_SF selects another scale."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    rows, difference = compare(queries()[name](spark, SF), con, oracle_sql()[name])
    assert difference == ""
    assert rows > 0


def test_entry_has_rows(spark):
    assert entry(spark).count() == 10
