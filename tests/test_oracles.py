"""Every registered query against its SQL oracle, and the driver contract."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
PLANS, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("key", list(PLANS))
def test_query(spark, duck, key):
    ok, message = compare(spark, duck, key, SMALL, PLANS, ORACLES)
    assert ok, message
    assert "types" not in message, message


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(PLANS)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "tag_ids"] and df.count() > 0
