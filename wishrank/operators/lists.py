"""The final recommendation lists and their length histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import LIST_SEP, importance_key, ordered_list
from ..params import Params

FINAL_COLS = ("custno", "recomdcount", "recomdlist")


def final_lists(merged: DataFrame, params: Params) -> DataFrame:
    """(custno, recomdcount, recomdlist) per customer.

    Buckets hold disjoint customers, so one grouped aggregate replaces the
    five-way UNION.  Items are listed by (lowest code, highest importance,
    item).
    """
    keyed = merged.withColumn("_ik", importance_key("importance", params))
    return keyed.groupBy("custno").agg(
        F.count(F.lit(1)).cast("int").alias("recomdcount"),
        ordered_list("recomdlist", "discounttype", "_ik DESC", "recomdlist").alias("recomdlist"),
    )


def listed(merged: DataFrame) -> DataFrame:
    """P21 from ``buckets.merged_entries``, whose arrays hold a customer's items in this order."""
    items = F.col("entries")["recomdlist"].cast("array<string>")  # of any collation, as they are spelled
    return merged.select("custno", F.size("entries").alias("recomdcount"), F.array_join(items, LIST_SEP).alias("recomdlist"))


def recomdcount_histogram(final: DataFrame) -> DataFrame:
    """How many customers have each list length, shortest first."""
    return final.groupBy("recomdcount").agg(F.count(F.lit(1)).alias("customers")).sort("recomdcount")
