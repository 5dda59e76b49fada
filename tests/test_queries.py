"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert entry.own_queries().keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(entry.own_queries()))
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 456
