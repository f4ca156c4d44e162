"""Lists as arrays of entries: same results as the stages over rows, and a lean last stage."""

import pytest
from pyspark.sql import functions as F

from wishrank import Inputs, Params, Recommender
from wishrank.functions.ordering import falling, falling_text, importance_key
from wishrank.operators import buckets, lists

TEXTS = ["", "0", "00", "1", "10", "10.0", "1e1", "9", "NaN", "Infinity", "-3", "-0.0", "A", "Z", "a", "z", "é", "￿", "\U0001f600", None]


@pytest.fixture(scope="module")
def inputs(spark):
    items = [f"g{k:02d}" for k in range(24)]
    wish = [(f"c{n}", items[(n * 5 + k * 7) % 24], f"cat{(n + k) % 3}" if k % 3 else None) for n in range(8) for k in range(n + 1)]
    pop = [(5 + k % 4, g, f"cat{k % 3}", f"par{k % 2}") for k, g in enumerate(items)] + [(9, "g03", "cat1", "cat2"), (9, "g04", "cat2", "cat2")]
    promo = [(g,) for g in items[::4]]
    assoc = [(g, items[(k * 3 + j) % 24], TEXTS[(k + j) % len(TEXTS)]) for k, g in enumerate(items) for j in range(6)]
    rules = [(g, items[(k * 3 + 2 * j) % 24], TEXTS[(k * 2 + j) % len(TEXTS)]) for k, g in enumerate(items) for j in range(6)]
    return Inputs(
        spark.createDataFrame(wish, "cust_no string, goods_code string, category_code string"),
        spark.createDataFrame(pop, "count int, goods_code string, category_code string, p2_category_code string"),
        spark.createDataFrame(promo, "goods_code string"),
        spark.createDataFrame(assoc, "goods_code string, recomd_list string, node_importance string"),
        spark.createDataFrame(rules, "icode string, rec_icode string, importance string"),
    )


def _rows(df, *cols):
    return sorted(tuple(str(v) for v in r) for r in df.select(*cols or df.columns).collect())


@pytest.mark.parametrize(
    "order, more",
    [("text", {}), ("text", {"budget": 3, "parent_backfill": True}), ("numeric", {}), ("numeric", {"backfill": True, "budget": 6}), ("text", {"fold_case": True, "backfill": True})],
)
def test_arrays_equal_the_stages_over_rows(inputs, spark, order, more):
    params = Params(importance_order=order, **more)
    rec = Recommender(spark, inputs, params)
    best = buckets.best_per_item(rec.bucket_candidates_full(), params)
    quota = buckets.quota_topk(best, params)
    merged = buckets.backfilled_items(best, params) if params.backfill else buckets.merge_items(quota, params)
    assert _rows(rec.quota_topk(), *quota.columns) == _rows(quota)
    assert _rows(rec.merge_items(), *merged.columns) == _rows(merged)
    assert _rows(rec.final_lists()) == _rows(lists.final_lists(merged, params))


@pytest.mark.parametrize("order", ["text", "numeric"])
def test_falling_turns_the_importance_key_round(spark, order):
    params = Params(importance_order=order)
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    down = df.sort(importance_key("t", params).desc(), falling_text(F.col("t"))).collect()
    assert df.sort(falling(F.col("t"), params), falling_text(F.col("t"))).collect() == down


def test_last_stage_sorts_no_rows_of_entries(inputs, spark):
    """The shuffle by customer carries a row per list, and no window ranks entries above it."""
    plan = Recommender(spark, inputs, Params(materialize=False)).final_lists()._jdf.queryExecution().executedPlan().toString()
    top, below = plan.split("REPARTITION_BY_COL", 1)
    assert "Window" not in top and "SortAggregate" not in top
    assert "entries#" in below
