"""Every registered query gives the rows, names and types of its oracle SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tidemark.plans.catalogue import ORACLES, QUERIES
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert difference(result, ORACLES[name], duck) is None


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert result.columns == ["order_date", "daily_revenue"]
    assert not result.isEmpty()
