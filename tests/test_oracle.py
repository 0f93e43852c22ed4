"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

from tidewire.plans.registry import all_oracle_sql, all_queries  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()  # those of the llm subpackage are tested in tests/llm
SQL = all_oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "key", "side", "value", "n"]
    assert df.count() > 0
