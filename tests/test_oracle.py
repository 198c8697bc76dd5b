"""The driver's correctness gate at the smallest scale: every registered query against its
DuckDB oracle (row count, column names, values without regard to order)."""

import os

import pytest

import __spark_entry__ as entry_module
from loopcount.plans import queries as count_queries
from tests import oracle_compare

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    return oracle_compare.duck(SF_DIR)


def test_every_query_on_counts_has_an_oracle():
    assert set(count_queries.QUERIES) <= set(entry_module.queries())
    assert set(count_queries.QUERIES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(count_queries.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    r = oracle_compare.compare(spark, duck, name, entry_module.queries()[name], entry_module.oracle_sql()[name], SF_DIR)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.count() == 12_768
    assert df.columns[:3] == ["feature_id", "site", "detector"]
