"""Catalog tables as inputs and outputs: the same rows as the Parquet path."""

import pytest

from wishrank import Params, Recommender, catalog_inputs, write_results

from .micro import micro_inputs
from .test_micro import FINAL_B, FLAT_B


@pytest.fixture
def database(spark, tmp_path):
    name = "wr_" + tmp_path.name.replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/warehouse'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_catalog_round_trip(spark, database):
    inputs = micro_inputs(spark)
    names = ("wishlist", "popularity", "promotion", "order_assoc", "rule_log")
    for n in names:
        getattr(inputs, n).write.saveAsTable(f"{database}.{n}")
    rec = Recommender(spark, catalog_inputs(spark, *(f"{database}.{n}" for n in names)), Params())
    for _ in range(2):  # overwriting gives the same tables
        out = write_results(rec, database=database)
        assert out["final_lists"] == f"{database}.final_lists"
        final = {r.custno: (r.recomdcount, r.recomdlist) for r in spark.table(out["final_lists"]).collect()}
        flat = {r.CustNO: r.Items for r in spark.table(out["flat_result"]).collect()}
        assert final == FINAL_B and flat == FLAT_B
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(spark.table(out["flat_topk"])) == rows(rec.flat_topk.select("CustNO", "item", "type"))
    assert rows(spark.table(out["flat_candidates"])) == rows(rec.flat_candidates().select("CustNO", "item", "type"))


def test_append_mode_adds_rows(spark, tmp_path):
    rec = Recommender(spark, micro_inputs(spark), Params(materialize=False))
    for _ in range(2):
        out = write_results(rec, path=str(tmp_path), mode="append", include_candidates=False)
    assert spark.read.parquet(out["flat_result"]).count() == 2 * len(FLAT_B)
    with pytest.raises(ValueError):
        write_results(rec)
