"""The per-goods and per-list cuts change no result: compare against uncut plans."""

import os

import pytest

from wishrank import Params, Recommender
from wishrank.operators import buckets, candidates, flat, lists

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("budget", [40, 7])
def test_quota_lists_cut_equals_full(spark, budget):
    r = Recommender.from_sf_dir(spark, SF, Params(budget=budget))
    full = buckets.best_per_item(r.bucket_candidates_full(), r.params)
    full_final = lists.final_lists(buckets.merge_items(buckets.quota_topk(full, r.params), r.params), r.params)
    assert _rows(r.final_lists()) == _rows(full_final)
    assert _rows(r.quota_topk()) == _rows(buckets.quota_topk(full, r.params))


@pytest.mark.parametrize("budget", [40, 5])
def test_flat_cut_equals_full(spark, budget):
    r = Recommender.from_sf_dir(spark, SF, Params(budget=budget))
    full = flat.flat_topk(flat.flat_candidates(r.assoc_candidates(), r.category_candidates()), r.params)
    cols = ["CustNO", "item", "type"]
    assert _rows(r.flat_topk.select(*cols)) == _rows(full.select(*cols))
    assert _rows(r.flat_result()) == _rows(flat.flat_result(full))


def test_binding_positions_are_dense(spark):
    r = Recommender.from_sf_dir(spark, SF, Params())
    b = r.binding.groupBy("level", "catecode").agg({"pos": "max", "*": "count"}).collect()
    assert all(row["max(pos)"] == row["count(1)"] for row in b)
    assert candidates.CAT in {row.level for row in b}
