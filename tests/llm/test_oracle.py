"""The operators that SQL can express, against DuckDB on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import compare, duck  # noqa: E402

from tidewire.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert r["ok"], r
