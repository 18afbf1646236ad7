"""Every query against its hand-written SQL on the smallest tables."""

from __future__ import annotations

import pytest
from comparing import differences, duck

import __spark_entry__ as entry
from subtide.plans.oracles import ORACLES
from subtide.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) == []


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() == 5
