"""Every catalogued query against its DuckDB statement at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, open_tables  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return open_tables(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    status, text = compare(spark, duck, SF, name, queries()[name], oracle_sql().get(name))
    assert status in ("ok", "rows-only"), f"{status} {text}"


def test_entry(spark):
    assert entry(spark).count() == 7
