"""Every registered query against its DuckDB statement on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
BUILDS, SQLS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(BUILDS))
def test_query(key, spark, duck):
    if key in SQLS:
        ok, detail = compare(key, BUILDS[key], SQLS[key], spark, SF_DIR, duck)
        assert ok, detail
    else:
        assert BUILDS[key](spark, SF_DIR).columns


def test_entry(spark):
    assert entry.entry(spark).count() > 0
