"""Fill in missing categories and parent categories of wishlist rows.

Two modes:

* ``left`` (default): the wishlist is de-duplicated first; a row whose
  category has no popularity match keeps a NULL parent, and a NULL-category
  row whose goods never sold keeps NULL category and parent.
* ``inner``: the raw wishlist is used (duplicates survive the parent fill);
  unmatched rows are dropped.

A NULL-category row takes the first (category, parent) known for its goods,
ordered by category then parent with NULLs first, in both modes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hot_keys import HotKeys
from ..functions.joins import keyed_join
from ..params import Params

FILLED_COLS = ("custno", "goodscode", "catecode", "p2code")


def wishlist_distinct(wishlist: DataFrame) -> DataFrame:
    """Distinct (customer, goods, category) rows."""
    return wishlist.select("cust_no", "goods_code", "category_code").distinct()


def fill_source(wishlist: DataFrame, params: Params) -> DataFrame:
    """The wishlist the fill reads: de-duplicated in ``left`` mode, raw in ``inner``."""
    return wishlist_distinct(wishlist) if params.fill_mode == "left" else wishlist


def category_parent_map(source: DataFrame, popularity: DataFrame, params: Params) -> DataFrame:
    """The wishlist's categories with every parent code popularity knows for them."""
    cats = source.select("category_code").distinct()
    pairs = popularity.select("category_code", "p2_category_code").distinct()
    return cats.join(pairs, "category_code", params.fill_mode)


def fill_parent(source: DataFrame, cmap: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Attach the parent code to rows that have a category.

    A category with several parent codes yields one row per parent.  Repeated
    rows (raw wishlists, ``inner`` mode) are counted first and spelled out after
    the join, so a category of any size is spread over tasks.
    """
    rows = source.filter(F.col("category_code").isNotNull()).groupBy("cust_no", "goods_code", "category_code").count()
    cmap = cmap.filter(F.col("category_code").isNotNull())
    out = keyed_join(rows, cmap, ["category_code"], "inner", hot)
    out = out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
    return out.select(
        F.col("cust_no").alias("custno"),
        F.col("goods_code").alias("goodscode"),
        F.col("category_code").alias("catecode"),
        F.col("p2_category_code").alias("p2code"),
    )


def first_category(popularity: DataFrame) -> DataFrame:
    """(goods_code, pick_category, pick_p2) for every goods that sells.

    The first (category, parent) per goods, NULLs first, as a grouped minimum
    of a struct (a partial aggregate, so a goods with many categories is cheap).
    """
    return popularity.groupBy("goods_code").agg(
        F.min(F.struct(F.col("category_code").alias("c"), F.col("p2_category_code").alias("p"))).alias("s")
    ).select(
        "goods_code",
        F.col("s.c").alias("pick_category"),
        F.col("s.p").alias("pick_p2"),
    )


def fill_category(source: DataFrame, popularity: DataFrame, params: Params, hot: HotKeys | None = None) -> DataFrame:
    """P5: one filled row per (customer, goods) among NULL-category rows."""
    # A NULL goods matches nothing, in both modes.
    rows = (
        source.filter(F.col("category_code").isNull() & F.col("goods_code").isNotNull())
        .select("cust_no", "goods_code")
        .distinct()
    )
    out = keyed_join(rows, first_category(popularity), ["goods_code"], params.fill_mode, hot)
    return out.select(
        F.col("cust_no").alias("custno"),
        F.col("goods_code").alias("goodscode"),
        F.col("pick_category").alias("catecode"),
        F.col("pick_p2").alias("p2code"),
    )


def filled_rows(source: DataFrame, popularity: DataFrame, params: Params, hot: dict[str, HotKeys] | None = None) -> DataFrame:
    """Parent-filled rows followed by category-filled rows of ``source`` (UNION ALL)."""
    hot = hot or {}
    cmap = category_parent_map(source, popularity, params)
    parents = fill_parent(source, cmap, hot.get("category"))
    return parents.unionByName(fill_category(source, popularity, params, hot.get("goods")))


def filled_wishlist(wishlist: DataFrame, popularity: DataFrame, params: Params, hot: dict[str, HotKeys] | None = None) -> DataFrame:
    """The filled rows of the wishlist that the fill mode reads."""
    return filled_rows(fill_source(wishlist, params), popularity, params, hot)


def filled_set(wishlist: DataFrame, popularity: DataFrame, params: Params, hot: dict[str, HotKeys] | None = None) -> DataFrame:
    """Distinct filled rows, computed from the distinct wishlist.

    Every later stage has set semantics, so the pipeline fills distinct rows
    only; this equals ``filled_wishlist(...).distinct()`` in both modes.
    """
    return filled_rows(wishlist_distinct(wishlist), popularity, params, hot).distinct()
