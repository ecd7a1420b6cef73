"""Every registered query against its SQL, and that all of them run."""

import os

import pytest

import __spark_entry__ as entry_point
from tools.check_oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert compare(result, duck, ORACLES[name]) is None
    else:
        assert result.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["genre", "avg_rating", "rating_cnt"]
