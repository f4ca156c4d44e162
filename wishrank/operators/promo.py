"""Flag popular goods that are on promotion.

``promotype`` is 1 when the goods is NOT in the promotion table and 0 when it
is, so items off promotion rank ahead.  A goods listed k times in the
promotion table turns each of its popularity rows into k rows; those copies
take best-seller slots (the rank is taken before duplicates are removed).

Inside the pipeline the copies are never materialised: ``weighted_popularity``
keeps one row per distinct popularity row with its number of copies in ``w``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hot_keys import HotKeys
from ..functions.joins import keyed_join

#: Copies of a row that one task spells out at a time.
COPIES = 1000

MPC_COLS = ("count", "goodscode", "catecode", "p2code", "promotype")


def promo_counts(promotion: DataFrame) -> DataFrame:
    """(goods_code, m): how many times a goods is listed on promotion."""
    return promotion.filter(F.col("goods_code").isNotNull()).groupBy("goods_code").agg(
        F.count(F.lit(1)).alias("m")
    )


def promo_flag(popularity: DataFrame, promotion: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The promotion-flagged popularity table with every copy spelled out.

    Equal popularity rows are counted first and joined to the *number* of promotion rows of
    their goods (one row per goods).  Goods without one have promotype 1 and their own
    copies; the others have as many times more.  Copies are spelled out in two levels with
    a shuffle between, so any number of them is spelled out by many tasks.
    """
    flagged = weighted_popularity(popularity, promotion, hot)
    blocks = flagged.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("w") - 1) / COPIES))).alias("_block"))
    copies = F.least(F.lit(COPIES), F.col("w") - F.col("_block") * COPIES)
    few = blocks.filter(F.col("w") <= COPIES)
    many = blocks.filter(F.col("w") > COPIES).repartition("goodscode", "catecode", "p2code", "count", "_block")
    return few.unionByName(many).select(*MPC_COLS, F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*MPC_COLS)


def weighted_popularity(popularity: DataFrame, promotion: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """(count, goodscode, catecode, p2code, promotype, w) with w copies per row.

    Identical popularity rows are collapsed first (n copies), then the
    promotion multiplicity m is applied: w = n * m, or n when not promoted.
    Both sides are aggregated per key before they meet, so no goods can blow
    up a task.
    """
    pop = popularity.groupBy(*popularity.columns).agg(F.count(F.lit(1)).alias("n"))
    joined = keyed_join(pop, promo_counts(promotion), ["goods_code"], "left", hot)
    return joined.select(
        F.col("count"),
        F.col("goods_code").alias("goodscode"),
        F.col("category_code").alias("catecode"),
        F.col("p2_category_code").alias("p2code"),
        F.when(F.col("m").isNull(), 1).otherwise(0).cast("int").alias("promotype"),
        (F.col("n") * F.coalesce(F.col("m"), F.lit(1))).alias("w"),
    )


def goods_flag(weighted: DataFrame) -> DataFrame:
    """(goodscode, promotype): the goods that sell, one row each.

    promotype depends on the goods alone, so one row per goods is exact.
    """
    return weighted.select("goodscode", "promotype").distinct()
