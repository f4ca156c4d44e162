"""The whole pipeline on shuffle joins, and with most keys hot: same rows."""

import os

import pytest

from wishrank import Params, Recommender

from .micro import micro_inputs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _rows(df):
    return df.columns, sorted(tuple(str(v) for v in r) for r in df.collect())


FRAMES = {
    "final_lists": lambda r: r.final_lists(),
    "flat_result": lambda r: r.flat_result(),
    "promo_flag": lambda r: r.promo_flag(),
    "filled_wishlist": lambda r: r.filled_wishlist(),
}


@pytest.mark.parametrize("union", ["true", "false"])
def test_shuffle_joins_end_to_end(spark, union):
    """Also with a Union that reports its children's partitioning (a setting of 4.1)."""
    base = Recommender.from_sf_dir(spark, SF, Params())
    want = {k: _rows(f(base)) for k, f in FRAMES.items()}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.unionOutputPartitioning": union,
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        forced = Recommender.from_sf_dir(spark, SF, Params(materialize=False))
        assert "BroadcastHashJoin" not in forced.final_lists()._jdf.queryExecution().executedPlan().toString()
        assert {k: _rows(f(forced)) for k, f in FRAMES.items()} == want
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_every_key_hot_end_to_end(spark, monkeypatch):
    """With the sketch's threshold near zero, all joins deal their keys into pieces."""
    from wishrank.functions import hot_keys

    frames = FRAMES | {"assoc": lambda r: r.assoc_candidates(), "best": lambda r: r.category_candidates(), "full": lambda r: r.bucket_candidates_full()}
    plain = Recommender.from_sf_dir(spark, SF, Params(split_hot=False))
    want = {k: _rows(f(plain)) for k, f in frames.items()}
    monkeypatch.setattr(hot_keys, "TASKS", 0.01)
    monkeypatch.setattr(hot_keys, "KEYS", 5000)
    split = Recommender.from_sf_dir(spark, SF, Params())
    assert len(split.hot_set["goods"].pieces) > 50 and split.hot_set["lists"] and split.hot_rules["item"] and split.hot_wishlist["category"]
    assert {k: _rows(f(split)) for k, f in frames.items()} == want
    plain.close(), split.close()


def test_building_runs_no_job_but_stage_writes(spark):
    """With every stage written once, building any frame again starts no job."""
    rec = Recommender.from_sf_dir(spark, SF, Params())
    for f in FRAMES.values():
        f(rec)
    rec.coverage_checks(), rec.category_candidates(), rec.assoc_candidates(), rec.bestsellers("cat")
    sc = spark.sparkContext
    sc.setJobGroup("build", "build")
    try:
        for f in FRAMES.values():
            f(rec)
        rec.coverage_checks(), rec.category_candidates(), rec.assoc_candidates(), rec.recomdcount_histogram()
        assert list(sc.statusTracker().getJobIdsForGroup("build")) == []
        lazy = Recommender(spark, micro_inputs(spark), Params(materialize=False))
        for f in FRAMES.values():
            f(lazy)
        lazy.coverage_checks(), lazy.quota_topk(), lazy.flat_candidates()
        assert list(sc.statusTracker().getJobIdsForGroup("build")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    rec.close()


def test_close_deletes_the_stages(spark):
    rec = Recommender.from_sf_dir(spark, SF, Params())
    rec.final_lists()
    folder = rec.stage.root.removeprefix("file:")
    assert os.listdir(folder)
    rec.close()
    assert not os.path.exists(folder)
