"""The driver's check in small: registered queries vs their DuckDB oracle SQL
on the sf0.001 driver tables (the full 29-key run is tests/oracle_check.py)."""

import os

import pytest

from .oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = ["final_lists", "final_lists_inner", "flat_result", "quota_topk", "best_per_item", "promo_flag"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, SF, key)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"] and r["values_match"], r
