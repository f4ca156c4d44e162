"""Result sinks: the four result tables, written in overwrite mode.

``write_results`` stores the flat candidates, the flat top list, the flat
result and the quota lists.  With ``database`` set they become catalog
tables (``saveAsTable``); otherwise Parquet folders under ``path``.  ``publish_results`` keeps
runs beside each other and lets readers switch between them (``publish.ResultStore``).
Overwrite mode replaces a table that exists; the flat result is then built from
the flat top list as written, so nothing is computed twice.
"""

from __future__ import annotations

import os
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

from ..functions.fingerprint import fingerprint
from ..operators.flat import flat_result
from .publish import ResultStore

if TYPE_CHECKING:
    from ..plans.recommend import Recommender

RESULT_TABLES = ("flat_candidates", "flat_topk", "flat_result", "final_lists")


def _write(df: DataFrame, name: str, path: str | None, database: str | None, mode: str) -> str:
    if database:
        target = f"{database}.{name}"
        df.write.mode(mode).format("parquet").saveAsTable(target)
        return target
    if not path:
        raise ValueError("give a path or a database")
    target = os.path.join(path, name)
    df.write.mode(mode).parquet(target)
    return target


def publish_results(rec: "Recommender", store: ResultStore, run_id: str, include_candidates: bool = True) -> dict[str, int]:
    """Writes the result tables of a run beside those of others, then switches readers to it.

    Repeating it with the same ``run_id`` replaces that run's rows.  Every table is read back
    and held against what was to be written, by its fingerprint, before the switch; a job
    that stops earlier leaves readers with the former run.  Returns {table: rows}.
    """
    topk = rec.stage(rec.flat_topk.select("CustNO", "item", "type"), "published_topk")
    frames = {"flat_topk": topk, "flat_result": flat_result(topk), "final_lists": rec.final}
    if include_candidates:
        frames["flat_candidates"] = rec.flat_candidates().select("CustNO", "item", "type")
    out = {}
    for name, rows in frames.items():
        rows = rec.stage(rows, f"published_{name}") if name != "flat_topk" else rows
        store.put(run_id, name, rows)
        wanted, written = fingerprint(rows), fingerprint(store.read(name, run_id).select(*rows.columns))
        if wanted != written:
            raise RuntimeError(f"{name} of run {run_id}: wrote {written}, wanted {wanted}")
        out[name] = written.rows
    store.publish(run_id)
    return out


def write_results(
    rec: "Recommender",
    path: str | None = None,
    database: str | None = None,
    mode: str = "overwrite",
    include_candidates: bool = True,
) -> dict[str, str]:
    """Write the result tables; returns {table: location}.

    ``include_candidates=False`` skips the full flat candidate table, which is
    by far the largest (every candidate of every wishlist row).
    """
    put = lambda df, name: _write(df, name, path, database, mode)
    out = {}
    if include_candidates:
        out["flat_candidates"] = put(rec.flat_candidates().select("CustNO", "item", "type"), "flat_candidates")
    topk = rec.flat_topk.select("CustNO", "item", "type")
    out["flat_topk"] = put(topk, "flat_topk")
    if mode == "overwrite":  # else the table also holds rows of earlier runs
        topk = rec.spark.table(out["flat_topk"]) if database else rec.spark.read.parquet(out["flat_topk"])
    out["flat_result"] = put(flat_result(topk), "flat_result")
    out["final_lists"] = put(rec.final_lists(), "final_lists")
    return out
