"""Every registered query against its SQL text, and the shape of the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_oracle import connect, differences

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    df = QUERIES[name](spark, data)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    row = entry.entry(spark).collect()
    assert len(row) == 1 and row[0]["folds"] == 10
