"""Candidate items from association rules and from best-sellers.

Association candidates depend on the wishlist goods only, so they are first
built per goods (``assoc_by_goods``) and joined to wishlist rows afterwards.
Best-seller lists (``binding``) hold at most ``2 * k`` items per category and
per parent code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hot_keys import HotKeys, find_hot_keys
from ..functions.joins import dealt, keyed_join
from ..functions.ordering import (
    ORDER_ASSOC,
    PARENT_CATEGORY,
    RULE_LOG,
    SAME_CATEGORY,
    discount_code,
    importance_key,
)
from ..params import Params

CAT, P2 = "cat", "p2"


def assoc_rules(order_assoc: DataFrame, rule_log: DataFrame) -> DataFrame:
    """(goodscode, recomdlist, importance, base) from both rule tables; NULL items dropped."""
    oa = order_assoc.filter(F.col("recomd_list").isNotNull()).select(
        F.col("goods_code").alias("goodscode"),
        F.col("recomd_list").alias("recomdlist"),
        F.col("node_importance").alias("importance"),
        F.lit(ORDER_ASSOC).alias("base"),
    )
    rl = rule_log.filter(F.col("rec_icode").isNotNull()).select(
        F.col("icode").alias("goodscode"),
        F.col("rec_icode").alias("recomdlist"),
        F.col("importance"),
        F.lit(RULE_LOG).alias("base"),
    )
    return oa.unionByName(rl)


def assoc_by_goods(rules: DataFrame, flags: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """(goodscode, recomdlist, importance, discounttype), distinct.

    Keeps an item only if it sells (appears in popularity), coded 1/2 when off
    promotion and 5/6 when promoted, through one join to the per-goods flag table.
    Repeated rules go before the join; an item has one flag, so no others arise.
    """
    f = flags.select(F.col("goodscode").alias("recomdlist"), F.col("goodscode").alias("_item"), "promotype")
    j = keyed_join(rules.distinct(), f, ["recomdlist"], "inner", hot)
    return j.select(
        "goodscode",
        F.col("_item").alias("recomdlist"),  # spelled as in popularity
        "importance",
        discount_code(F.col("base"), F.col("promotype")).alias("discounttype"),
    )


def assoc_candidates(filled: DataFrame, assoc: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Association candidates of every filled wishlist row."""
    j = keyed_join(filled.select("custno", "goodscode", "catecode").distinct(), assoc, ["goodscode"], "inner", hot)
    return j.select(
        F.col("custno").alias("cust_no"),
        "goodscode",
        "catecode",
        "recomdlist",
        "importance",
        "discounttype",
    ).distinct()


def assoc_best_top(assoc: DataFrame, params: Params) -> DataFrame:
    """Per goods, each item once with its best (code, importance), top ``budget`` kept.

    A wishlist row can keep at most ``budget`` items, and an association item
    that is not among its goods' best ``budget`` items is beaten by that many
    items in any candidate set the goods feeds, so it can never be kept.
    Cutting here bounds every wishlist row's association fan-out by
    ``budget`` without changing any result.
    """
    key = importance_key("importance", params)
    best = assoc.groupBy("goodscode", "recomdlist").agg(
        F.max(
            F.struct(
                (-F.col("discounttype")).alias("nc"),
                key.alias("ik"),
                F.col("importance").alias("imp"),
            )
        ).alias("b")
    ).select(
        "goodscode",
        "recomdlist",
        (-F.col("b.nc")).cast("int").alias("discounttype"),
        F.col("b.imp").alias("importance"),
        F.col("b.ik").alias("_ik"),
    )
    w = Window.partitionBy("goodscode").orderBy(
        F.col("discounttype"), F.col("_ik").desc(), F.col("recomdlist")
    )
    return (
        best.withColumn("pos", F.row_number().over(w))
        .filter(F.col("pos") <= params.budget)
        .drop("_ik")
    )


def flat_binding(bind: DataFrame, params: Params) -> DataFrame:
    """Best-seller entries that can still reach a customer's first ``budget`` flat rows.

    A row's entries from one list come in (code, item) order; an entry with
    ``budget + 1`` entries of its list ahead of it has at least ``budget``
    distinct rows of the same customer ahead of it (the row's own goods is
    the only entry the row skips), so it can never be taken.
    """
    return bind.filter(F.col("pos") <= params.budget + 1)


def assoc_flat_top(assoc: DataFrame, params: Params) -> DataFrame:
    """Per goods, the first ``budget`` distinct (item, importance, code) by (code, item, importance).

    The flat list takes a customer's first ``budget`` rows by (type, item); a
    row beyond its goods' first ``budget`` has that many distinct rows of the
    same customer ahead of it, so it can never be taken.
    """
    w = Window.partitionBy("goodscode").orderBy("discounttype", "recomdlist", "importance")
    return (
        assoc.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= params.budget)
        .drop("_rn")
    )


def _present_codes(filled: DataFrame, level: str) -> DataFrame:
    col = "catecode" if level == CAT else "p2code"
    return filled.select(F.col(col).alias("key")).filter(F.col("key").isNotNull()).distinct()


def bestsellers(weighted: DataFrame, filled: DataFrame, level: str, params: Params) -> DataFrame:
    """P8 for one level: (catecode, recomdlist, discounttype) best-sellers.

    ``level`` is ``cat`` (codes 3 and 7, ranked per category) or ``p2``
    (codes 4 and 8, ranked per parent code; ``catecode`` then holds the
    parent code).  Only codes present in the filled wishlist are ranked.

    Each weighted row stands for ``w`` identical copies, and copies use up
    slots because the rank comes before the distinct.  A row is kept when its
    first copy ranks within ``k``: row_number <= k first (a partial top-k on
    the map side, safe for a hot category), then a running sum of the weights.
    """
    key, other = ("catecode", "p2code") if level == CAT else ("p2code", "catecode")
    base = SAME_CATEGORY if level == CAT else PARENT_CATEGORY
    w = Window.partitionBy(key, "promotype").orderBy(
        F.col("count").desc(), F.col("goodscode"), F.col(other)
    )
    # Rank first (at most k rows per code leave a task), then keep the present codes.
    ranked = (
        weighted.filter(F.col(key).isNotNull())
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= params.k)
    )
    ranked = ranked.withColumn(
        "_run", F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).filter(F.col("_run") - F.col("w") < params.k)
    ranked = ranked.join(_present_codes(filled, level).withColumnRenamed("key", key), key, "left_semi")
    return ranked.select(
        F.col(key).alias("catecode"),
        F.col("goodscode").alias("recomdlist"),
        discount_code(base, F.col("promotype")).alias("discounttype"),
    ).distinct()


def binding(weighted: DataFrame, filled: DataFrame, params: Params) -> DataFrame:
    """(level, catecode, recomdlist, discounttype, pos) for both levels.

    ``pos`` numbers a code's list by (code, item): later stages use it to skip
    entries that enough better entries of the same list already beat.  A NULL item
    holds a best-seller slot but is never recommended, so it is numbered last.
    The table has at most 2 * k rows per code, so the window is cheap.
    """
    both = bestsellers(weighted, filled, CAT, params).withColumn("level", F.lit(CAT)).unionByName(
        bestsellers(weighted, filled, P2, params).withColumn("level", F.lit(P2))
    )
    w = Window.partitionBy("level", "catecode").orderBy(F.col("recomdlist").isNull(), "discounttype", "recomdlist")
    return both.withColumn("pos", F.row_number().over(w))


def level_keys(*pairs) -> Column:
    """One (level, key) struct per pair, exploded into rows in a single pass
    (no union of several projections of the same frame)."""
    return F.explode(
        F.array(*[F.struct(F.lit(level).alias("level"), key.alias("key")) for level, key in pairs])
    ).alias("lk")


def hot_keys_of_set(wset: DataFrame) -> dict[str, HotKeys]:
    """Hot goods and hot (level, code) lists of the filled set, in one pass."""
    cat, p2 = [F.lit(CAT), F.col("catecode")], [F.lit(P2), F.col("p2code")]
    # Lists are also looked up at the parent level by a row's category.
    found = find_hot_keys(wset, goods=[F.col("goodscode")], cat=cat, p2=p2, cross=[F.lit(P2), F.col("catecode")])
    return {"goods": found["goods"], "lists": found["cross"] | found["p2"] | found["cat"]}


def code_summaries(wset: DataFrame) -> DataFrame:
    """(custno, level, key, gmin, gmax): min and max goods of a customer's rows per code.

    A customer's rows with code ``key`` at ``level`` bring that code's
    best-seller list, each minus its own goods; together that is the whole
    list unless all those rows carry one and the same goods g (gmin = gmax =
    g), in which case only g is missing.  NULL goods bring nothing.
    """
    return (
        wset.select("custno", "goodscode", level_keys((CAT, F.col("catecode")), (P2, F.col("p2code"))))
        .select("custno", "lk.level", "lk.key", "goodscode")
        .filter(F.col("key").isNotNull() & F.col("goodscode").isNotNull())
        .groupBy("custno", "level", "key")
        .agg(F.min("goodscode").alias("gmin"), F.max("goodscode").alias("gmax"))
    )


def category_candidates(filled: DataFrame, bind: DataFrame, hot: HotKeys | None = None, tasks: int | None = None) -> DataFrame:
    """Best-sellers of each row's category and parent, minus the row's goods.

    (cust_no, catecode, recomdlist, discounttype), distinct; catecode holds
    the category for codes 3/7 and the parent code for 4/8.

    Built from the per (customer, level, code) goods summaries: a list's
    entries are distinct items and the two levels never share a code, so the
    join yields every row once and no de-duplication shuffle is needed.  With ``tasks`` the
    summaries are dealt by customer first, which a broadcast of the lists keeps.
    """
    return list_entries(dealt(code_summaries(filled), tasks, "custno"), bind, hot).select(
        F.col("custno").alias("cust_no"),
        F.col("key").alias("catecode"),
        "recomdlist",
        "discounttype",
    )


def list_entries(summ: DataFrame, bind: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """(custno, level, key, recomdlist, discounttype): each summarised list of a
    customer, minus the goods when all of the customer's rows there carry it.
    NULL items are never recommended."""
    b = bind.filter(F.col("recomdlist").isNotNull()).select("level", F.col("catecode").alias("key"), "recomdlist", "discounttype")
    return keyed_join(summ, b, ["level", "key"], "inner", hot).filter(
        ~((F.col("gmin") == F.col("gmax")) & (F.col("gmin") == F.col("recomdlist")))
    )
