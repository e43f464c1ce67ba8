"""Every query against the same query in SQL, on all given rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from shelfline.catalog.oracle import ORACLE
from shelfline.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_same_rows(spark, con, name):
    assert difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
