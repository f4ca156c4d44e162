"""Plan shape: the scale properties the README promises, read off explain()."""

import os
import re

import pytest

from wishrank import Params, Recommender

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rec(spark):
    return Recommender.from_sf_dir(spark, SF, Params())


def test_final_lists_single_customer_shuffle(rec):
    plan = _plan(rec.final_lists())
    # One explicit shuffle by customer feeds best-per-item, quota, merge and list.
    assert plan.count("REPARTITION_BY_COL") == 1
    top = plan.split("REPARTITION_BY_COL")[0]
    assert "ENSURE_REQUIREMENTS" not in top
    # Partial top-k before the shuffle: the per-customer index (5).
    assert "row_number(), 5, Partial" in plan


def test_flat_candidates_are_cut_before_their_one_shuffle(rec):
    plan = _plan(rec.flat_result())
    lines = plan.splitlines()
    union = next(k for k, line in enumerate(lines) if re.search(r"\bUnion$", line.strip()))
    above = lines[:union]
    # One shuffle by customer above the union, with a partial limit of both parts below it.
    shuffles = [k for k, line in enumerate(above) if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "hashpartitioning(CustNO" in above[shuffles[0]]
    assert any(re.search(r"WindowGroupLimit.*dense_rank.*, 40, Partial", line) for line in above[shuffles[0] :])


def test_bestsellers_partial_limit(rec, spark):
    from wishrank.operators import candidates

    df = candidates.bestsellers(rec.weighted, rec.wishlist_set, candidates.CAT, rec.params)
    plan = _plan(df)
    assert "row_number(), 40, Partial" in plan
    # Ranked first: the semi join with the present codes stands above the partial limit.
    assert plan.index("LeftSemi") < plan.index("row_number(), 40, Partial")


def test_scans_are_pruned_and_filtered(spark):
    from wishrank.sources.inputs import derive_wishlist

    df = derive_wishlist(spark, SF, Params())
    plan = df._jdf.queryExecution().executedPlan().toString()
    li = [line for line in plan.splitlines() if "lineitem" in line][0]
    assert "l_extendedprice" not in li and "l_shipdate" not in li
    assert "GreaterThanOrEqual(l_quantity,47.0)" in li


def _above(plan: str, node: str) -> list[str]:
    lines = plan.splitlines()
    return lines[: next(k for k, line in enumerate(lines) if re.search(node, line.strip()))]


def test_full_candidates_are_grouped_where_their_lists_are_spelled_out(rec):
    from wishrank.functions.fingerprint import distinct_check

    best = _plan(rec.best_per_item(full=True))
    assert not [line for line in _above(best, r"\bUnion$") if "Exchange" in line]
    assert len(re.findall(r"Exchange hashpartitioning\(custno#\d+, \d+\), REPARTITION_BY_NUM", best)) == 2
    # The check for repeated rows shuffles its one row per bucket and task only.
    checked = [line for line in _above(_plan(distinct_check(rec.bucket_candidates_full(), by="bucket")), r"\bUnion$") if "Exchange" in line]
    assert len(checked) == 1 and "hashpartitioning(bucket" in checked[0]


def test_flat_candidates_shuffle_no_spelled_out_list(rec):
    plan = _plan(rec.flat_candidates())
    assert not re.search(r"Exchange hashpartitioning\(cust_?no#\d+, recomdlist#\d+, discounttype", plan, re.IGNORECASE)


def test_flat_rows_are_dealt_before_lists_are_spelled_out(rec):
    union = _plan(rec.flat_result()).split("Union", 1)[1]
    assert union.count("REPARTITION_BY_NUM") >= 1
    assert re.search(r"Exchange hashpartitioning\(custno#\d+, \d+\), REPARTITION_BY_NUM", union)


def test_tasks_follow_the_rows(rec, monkeypatch):
    from wishrank.plans import recommend

    fresh = Recommender.from_sf_dir(rec.spark, SF, Params())
    monkeypatch.setattr(recommend, "ROWS_PER_TASK", 10)
    assert fresh.tasks == -(-fresh.wishlist_set.count() // 10)
