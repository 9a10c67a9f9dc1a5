"""Every registered query against its DuckDB statement on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from ledgerloom.plans import registry
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
registry.load_all()
# The library's own queries; those of other subpackages have tests of their own.
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(registry.ORACLE) == set(NAMES)
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"category", "sub_category", "total_sales", "pct_of_total"} <= set(df.columns)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert r["status"] == "ok", r
