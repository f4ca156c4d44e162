"""keyed_join: with or without hot keys, it gives the plain join's rows and columns."""

import pytest
from pyspark.sql import functions as F

from wishrank import Params, Recommender
from wishrank.functions.hot_keys import HotKeys, find_hot_keys, key_hash
from wishrank.functions.joins import keyed_join

from .micro import micro_inputs


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(
        [("h", i, f"l{i}") for i in range(40)] + [("a", 1, "x"), ("b", 2, "y"), (None, 3, "z"), (None, 4, "z")],
        "k string, lv int, ls string",
    )
    right = spark.createDataFrame(
        [("h", i) for i in range(10)] + [("a", 7), ("c", 8), (None, 9)],
        "k string, rv int",
    )
    return left, right


@pytest.fixture
def settings(spark):
    """Sets session settings and puts them back."""
    before = {}

    def put(**values):
        for k, v in values.items():
            k = k.replace("__", ".")
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("keys", ["none", "found", "all"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_plain(spark, sides, how, keys):
    left, right = sides
    if how in ("left_semi", "left_anti"):
        right = right.select("k").distinct()
    hot = {"none": None, "found": find_hot_keys(left, k=[F.col("k")])["k"]}.get(keys)
    if keys == "all":  # null ones and keys of one side only as well
        every = left.select("k").unionByName(right.select("k")).distinct()
        hot = HotKeys({r[0]: 3 for r in every.select(key_hash("k")).collect()})
    plain = left.join(right, "k", how)
    got = keyed_join(left, right, ["k"], how, hot)
    assert got.columns == plain.columns
    assert _rows(got) == _rows(plain)


def test_two_key_columns(spark):
    left = spark.range(300).selectExpr("id", "if(id % 3 = 0, 'cat', 'p2') AS level", "if(id % 2 = 0, 'x', cast(id AS string)) AS key")
    right = spark.createDataFrame([("cat", "x", 1), ("cat", "x", 2), ("p2", "x", 3), ("p2", "7", 4)], "level string, key string, v int")
    hot = find_hot_keys(left, both=[F.col("level"), F.col("key")])["both"]
    assert len(hot.pieces) == 1  # (p2, x) holds a third of the rows
    assert _rows(keyed_join(left, right, ["level", "key"], "inner", hot)) == _rows(left.join(right, ["level", "key"]).select("id", "level", "key", "v"))


def test_sketch_finds_hot_keys_and_no_others(spark, settings):
    settings(spark__sql__shuffle__partitions="32")
    third = F.when(F.col("id") % 3 == 0, F.lit("h")).otherwise(F.col("id").cast("string"))
    frame = spark.range(30_000).select(third.alias("k"), F.when(F.col("id") % 10 == 0, F.lit("n")).alias("few"))
    found = find_hot_keys(frame, k=[F.col("k")], few=[F.col("few")])
    (hash_, pieces), = found["k"].pieces.items()
    assert hash_ == spark.sql("SELECT xxhash64('h')").first()[0] and 20 <= pieces <= 24
    assert list(found["few"].pieces.values()) == [32]  # shares are of the rows with a key
    assert len(find_hot_keys(frame, True, few=[F.col("few")])["few"].pieces) == 2  # null is a key
    assert not find_hot_keys(frame.filter("k <> 'h'"), k=[F.col("k")])["k"]
    assert not find_hot_keys(frame.limit(0), k=[F.col("k")])["k"]


def test_hot_key_is_spread(spark, settings):
    """A key with a third of the rows goes to more than eight tasks; cold keys are not repeated."""
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="32")
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("h")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = left.select("k").distinct().withColumn("v", F.lit(1)).hint("merge")
    hot = find_hot_keys(left, k=[F.col("k")])["k"]
    parts = lambda hot: keyed_join(left, right, ["k"], "inner", hot).filter("k = 'h'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts(None)) == 1
    spread = [r["count"] for r in parts(hot)]
    assert len(spread) > 8 and max(spread) < 0.3 * sum(spread) and sum(spread) == 10_000


def test_collated_keys_stay_whole(spark):
    left = spark.createDataFrame([("Ab", 1), ("aB ", 2), ("AB", 3), ("c", 4)], "k string, v int").withColumn("k", F.collate("k", "UTF8_LCASE_RTRIM"))
    right = left.select("k", F.col("v").alias("w"))
    hot = find_hot_keys(left, k=[F.col("k")], v=[F.col("v")])
    assert not hot["k"] and keyed_join(left, right, ["k"], "inner", hot["k"]).count() == 10


def test_no_generate_without_hot_keys(spark, sides):
    left, right = sides
    for hot in (None, HotKeys()):
        plan = keyed_join(left, right, ["k"], "inner", hot)._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "SinglePartition" not in plan
    hot = find_hot_keys(left, k=[F.col("k")])["k"]
    plan = keyed_join(left, right, ["k"], "inner", hot)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and "SinglePartition" not in plan


def test_joining_runs_no_job(spark, sides):
    left, right = sides
    hot = find_hot_keys(left, k=[F.col("k")])["k"]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("joins", "joins")
    try:
        keyed_join(left, right, ["k"], "inner", hot)
        assert list(tracker.getJobIdsForGroup("joins")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_goods_of_a_run(spark):
    """One goods holds most wishlist rows and rules: found in the stages, same lists as without."""
    wishlist = [(f"U{k}", "G1" if k % 5 else f"G{k}", "C1" if k % 3 else None) for k in range(200)]
    rules = [("G1", f"G{k}", str(k)) for k in range(60)] + [(f"G{k}", "G1", "3") for k in range(2, 200)]
    popularity = [(k, f"G{k}", f"C{k % 4}", "P1") for k in range(1, 60)]
    inputs = micro_inputs(spark, wishlist, popularity, [("G2",)] * 3, rules, [])
    hot, plain = Recommender(spark, inputs, Params()), Recommender(spark, inputs, Params(split_hot=False))
    assert hot.hot_set["goods"] and hot.hot_rules["item"] and hot.hot_wishlist["category"] and not plain.hot_set
    for f in ("final_lists", "flat_result", "assoc_candidates", "category_candidates", "filled_wishlist"):
        assert _rows(getattr(hot, f)()) == _rows(getattr(plain, f)())
    hot.close(), plain.close()
