"""The flat list — first ``budget`` candidates per customer by type.

No per-item de-duplication happens here: an item can appear once per code,
and an association item once per distinct importance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hot_keys import HotKeys
from ..functions.joins import dealt, keyed_join
from ..functions.ordering import ordered_list
from ..params import Params
from .candidates import code_summaries, list_entries

FLAT_COLS = ("CustNO", "item", "type")


def flat_candidates(ar: DataFrame, tp: DataFrame) -> DataFrame:
    """P10: association rows distinct on (customer, item, importance, code)
    plus best-seller rows distinct on (customer, item, code).

    The importance is carried as a hidden tie-breaker column ``_imp`` so that the
    following top-k is deterministic; it is not part of the stage's output.
    """
    a = ar.select("cust_no", "recomdlist", "importance", "discounttype").distinct().select(
        F.col("cust_no").alias("CustNO"),
        F.col("recomdlist").alias("item"),
        F.col("discounttype").cast("string").alias("type"),
        F.col("importance").alias("_imp"),
    )
    t = tp.select("cust_no", "recomdlist", "discounttype").distinct().select(
        F.col("cust_no").alias("CustNO"),
        F.col("recomdlist").alias("item"),
        F.col("discounttype").cast("string").alias("type"),
        F.lit(None).cast("string").alias("_imp"),
    )
    return a.unionByName(t)


def flat_candidates_cut(
    wset: DataFrame,
    assoc_top: DataFrame,
    bind: DataFrame,
    params: Params,
    hot: dict[str, HotKeys] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Flat candidates built straight from the filled set with one de-duplication.

    ``assoc_top`` and ``bind`` are already cut to what a customer's first
    ``budget`` rows can use.  Best-seller rows come once per (customer, list)
    from the goods summaries, but one item can sit in two of a customer's
    lists, and the flat table keeps it once per code; association rows are
    kept once per (item, importance, code).  Both parts never share a code,
    so one distinct over (customer, item, type, importance) covers both.  Rows are dealt
    over ``tasks`` before lists are spelled out, so what a task sorts does not grow with the
    input.
    """
    hot = hot or {}
    # A hot goods is dealt into pieces by its join instead.
    rows = dealt(wset.select("custno", "goodscode"), None if hot.get("goods") else tasks, "goodscode")
    ar = (
        keyed_join(rows, assoc_top, ["goodscode"], "inner", hot.get("goods"))
        .select(
            F.col("custno").alias("CustNO"),
            F.col("recomdlist").alias("item"),
            F.col("discounttype").cast("string").alias("type"),
            F.col("importance").alias("_imp"),
        )
    )
    tp = list_entries(dealt(code_summaries(wset), tasks, "custno"), bind, hot.get("lists")).select(
        F.col("custno").alias("CustNO"),
        F.col("recomdlist").alias("item"),
        F.col("discounttype").cast("string").alias("type"),
        F.lit(None).cast("string").alias("_imp"),
    )
    # A value outside a customer's ``budget`` smallest has that many distinct rows ahead
    # of it.  dense_rank keeps every copy of the values it keeps and runs as a partial
    # top-k on both parts before their one shuffle, so a customer ships the copies of at
    # most ``budget`` values per task.  The distinct and the top list reuse that shuffle.
    w = Window.partitionBy("CustNO").orderBy("type", "item", "_imp")
    both = ar.unionByName(tp).withColumn("_dr", F.dense_rank().over(w))
    return both.filter(F.col("_dr") <= params.budget).drop("_dr").distinct()


def flat_topk(flat: DataFrame, params: Params) -> DataFrame:
    """First ``budget`` rows per customer by (type, item).

    ``row_number() <= budget`` is planned as a partial top-k before the shuffle,
    so a customer with a huge candidate set sends at most ``budget`` rows per
    map task.
    """
    w = Window.partitionBy("CustNO").orderBy("type", "item", "_imp")
    return (
        flat.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= params.budget)
        .drop("_rn")
    )


def flat_result(topk: DataFrame) -> DataFrame:
    """One comma-joined list per customer, ordered by (type, item).

    Rows without a customer form one row whose list is NULL (no customer equals NULL).
    """
    return topk.groupBy("CustNO").agg(ordered_list("item", "type", "item").alias("Items")).select(
        "CustNO", F.when(F.col("CustNO").isNotNull(), F.col("Items")).alias("Items")
    )
