"""Every registered query against its checking SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from check import compare, duck
from noticeworks.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_checking_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(name, entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
