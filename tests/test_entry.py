"""Driver contract: entry() runs, every query has SQL, and Spark agrees with DuckDB at sf0.001."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from kpi_lake.plans.catalog import QUERIES
from tools.compare_oracle import compare

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["industry", "total_sales"]
    assert len(rows) > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, sorted(QUERIES))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(results, name):
    assert results[name].startswith("ok"), results[name]
