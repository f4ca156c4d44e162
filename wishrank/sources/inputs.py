"""The five pipeline inputs: wishlist, popularity, promotion, order_assoc, rule_log.

``DerivedInputs`` builds them from the driver's TPC-H-like tables the way
FIXTURES.md describes (orders play wishlists, parts play goods, brands play
parent categories).  ``catalog_inputs`` reads real tables of the same shape.
Both hold raw frames; ``CleanInputs`` applies the ingest rules (trim codes, fold
their case on request) before any stage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import keyed_join
from ..params import Params
from . import tables
from .context import current_database

WISHLIST_COLS = ("cust_no", "goods_code", "category_code")
POPULARITY_COLS = ("count", "goods_code", "category_code", "p2_category_code")
PROMOTION_COLS = ("goods_code",)
ORDER_ASSOC_COLS = ("goods_code", "recomd_list", "node_importance")
RULE_LOG_COLS = ("icode", "rec_icode", "importance")

# Fixed values of the fixture derivation (FIXTURES.md).
WISH_MIN_QTY = 47          # order lines that become wishlist rows
ASSOC_PARTNER_MIN_QTY = 25  # lines that count as bought together
UNKNOWN_CATEGORY_LINE = 1  # line number whose category is blanked
MISSING_GOODS_MOD, MISSING_GOODS_REM = 10, 9
MISSING_BRAND_PREFIX = "Brand#7/"
OUTLET_SIZE_MOD = 10
OUTLET = "Outlet"
PROMO_MAX_SIZE, PROMO_REPEAT_MAX_SIZE = 15, 3


#: The driver tables that the inputs are derived from.
DERIVED_FROM = ("part", "lineitem", "orders")


@dataclass(frozen=True)
class Inputs:
    wishlist: DataFrame
    popularity: DataFrame
    promotion: DataFrame
    order_assoc: DataFrame
    rule_log: DataFrame


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part: goods code, category (brand/type), parent (brand)."""
    p = tables.part(spark, sf_dir)
    return p.select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("goods_code"),
        F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")).alias("category_code"),
        F.col("p_brand").alias("p2_category_code"),
        "p_size",
    )


def derive_wishlist(spark: SparkSession, sf_dir: str, params: Params) -> DataFrame:
    li = (
        tables.lineitem(spark, sf_dir)
        .filter(F.col("l_quantity") >= WISH_MIN_QTY)
        .select("l_orderkey", "l_partkey", "l_linenumber")
    )
    o = tables.orders(spark, sf_dir).withColumnRenamed("o_orderkey", "l_orderkey")
    g = goods(spark, sf_dir).select(
        F.col("p_partkey").alias("l_partkey"), "goods_code", "category_code"
    )
    lo = keyed_join(li, o, ["l_orderkey"])
    log = keyed_join(lo, g, ["l_partkey"])
    return log.select(
        F.col("o_custkey").cast("string").alias("cust_no"),
        "goods_code",
        F.when(F.col("l_linenumber") == UNKNOWN_CATEGORY_LINE, F.lit(None).cast("string"))
        .otherwise(F.col("category_code"))
        .alias("category_code"),
    )


def derive_popularity(spark: SparkSession, sf_dir: str, params: Params) -> DataFrame:
    # Count lines per part first, so the goods join sees one row per part.
    sold = (
        tables.lineitem(spark, sf_dir)
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count(F.lit(1)).cast("int").alias("count"))
    )
    g = goods(spark, sf_dir)
    sg = keyed_join(sold, g, ["p_partkey"])
    main = sg.filter(
        (F.pmod(F.col("p_partkey"), F.lit(MISSING_GOODS_MOD)) != MISSING_GOODS_REM)
        & ~F.col("category_code").startswith(MISSING_BRAND_PREFIX)
    ).select("count", "goods_code", "category_code", "p2_category_code")
    outlet = sg.filter(F.pmod(F.col("p_size"), F.lit(OUTLET_SIZE_MOD)) == 0).select(
        "count",
        "goods_code",
        F.concat(F.lit(OUTLET + "/"), F.col("p2_category_code")).alias("category_code"),
        F.lit(OUTLET).alias("p2_category_code"),
    )
    return main.unionByName(outlet)


def derive_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = goods(spark, sf_dir)
    return (
        g.filter(F.col("p_size") <= PROMO_MAX_SIZE).select("goods_code")
        .unionByName(g.filter(F.col("p_size") <= PROMO_REPEAT_MAX_SIZE).select("goods_code"))
    )


def derive_order_assoc(spark: SparkSession, sf_dir: str, params: Params) -> DataFrame:
    """Parts bought together.  By definition a pair table: an order with A wished and B
    partner parts gives A x B pairs, so its size is quadratic in the parts of one order
    (at most seven here).  Real association tables are read as given."""
    li = tables.lineitem(spark, sf_dir)
    # Pre-aggregate each side per (order, part) before the order self-join:
    # every line of part A pairs with every line of part B, so the pair's
    # quantity sum is (#A lines) * (B quantity sum).
    a = (
        li.filter(F.col("l_quantity") >= WISH_MIN_QTY)
        .groupBy("l_orderkey", F.col("l_partkey").alias("a_part"))
        .agg(F.count(F.lit(1)).alias("a_lines"))
    )
    b = (
        li.filter(F.col("l_quantity") >= ASSOC_PARTNER_MIN_QTY)
        .groupBy("l_orderkey", F.col("l_partkey").alias("b_part"))
        .agg(F.sum("l_quantity").alias("b_qty"))
    )
    # Both sides are large; a hot order is left to adaptive skew-join splitting,
    # which cuts an oversized shuffle partition on both sides at run time.
    pairs = a.join(b, "l_orderkey", "inner")
    return (
        pairs.filter(F.col("a_part") != F.col("b_part"))
        .groupBy("a_part", "b_part")
        .agg(F.sum(F.col("a_lines") * F.col("b_qty")).alias("qty"))
        .select(
            F.col("a_part").cast("string").alias("goods_code"),
            F.col("b_part").cast("string").alias("recomd_list"),
            F.col("qty").cast("bigint").cast("string").alias("node_importance"),
        )
    )


def derive_rule_log(spark: SparkSession, sf_dir: str, params: Params) -> DataFrame:
    li = tables.lineitem(spark, sf_dir)
    a = li.filter(F.col("l_quantity") >= WISH_MIN_QTY).select(
        "l_orderkey",
        (F.col("l_linenumber") + 1).alias("next_line"),
        F.col("l_partkey").alias("a_part"),
    )
    b = li.select(
        "l_orderkey",
        F.col("l_linenumber").alias("next_line"),
        F.col("l_partkey").alias("b_part"),
        "l_discount",
    )
    # (order, line) is a key of lineitem: no key can be hot on the right side.
    nxt = a.join(b, ["l_orderkey", "next_line"], "inner")
    return nxt.select(
        F.col("a_part").cast("string").alias("icode"),
        F.col("b_part").cast("string").alias("rec_icode"),
        F.round(F.lit(100) * F.col("l_discount")).cast("int").cast("string").alias("importance"),
    ).distinct()


class DerivedInputs:
    """The five inputs of a folder of driver tables, each derived and staged on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params, stage: Callable[[DataFrame, str], DataFrame]):
        self._args, self._stage = (spark, sf_dir, params), stage

    @cached_property
    def wishlist(self) -> DataFrame:
        return self._stage(derive_wishlist(*self._args), "wishlist")

    @cached_property
    def popularity(self) -> DataFrame:
        return self._stage(derive_popularity(*self._args), "popularity")

    @cached_property
    def promotion(self) -> DataFrame:
        return self._stage(derive_promotion(*self._args[:2]), "promotion")

    @cached_property
    def order_assoc(self) -> DataFrame:
        return self._stage(derive_order_assoc(*self._args), "order_assoc")

    @cached_property
    def rule_log(self) -> DataFrame:
        return self._stage(derive_rule_log(*self._args), "rule_log")


def mixed_spellings(inputs) -> Inputs:
    """The inputs with some wishlist categories in capitals and with blanks at the end.

    Odd customers write them so; a job that folds case must not see a difference.
    """
    odd = F.col("cust_no").cast("long") % 2 == 1
    category = F.when(odd, F.concat(F.upper("category_code"), F.lit("  "))).otherwise(F.col("category_code"))
    wishlist = inputs.wishlist.withColumn("category_code", category)
    return Inputs(wishlist, inputs.popularity, inputs.promotion, inputs.order_assoc, inputs.rule_log)


def catalog_inputs(
    spark: SparkSession,
    wishlist: str,
    popularity: str,
    promotion: str,
    order_assoc: str,
    rule_log: str,
    database: str | None = None,
) -> Inputs:
    """Inputs from catalog tables or views.

    Names without a database mean temporary views first, then tables of ``database``, or of
    the session's current one.
    """
    with current_database(spark, database):
        return Inputs(
            wishlist=spark.table(wishlist).select(*WISHLIST_COLS),
            popularity=spark.table(popularity).select(*POPULARITY_COLS),
            promotion=spark.table(promotion).select(*PROMOTION_COLS),
            order_assoc=spark.table(order_assoc).select(*ORDER_ASSOC_COLS),
            rule_log=spark.table(rule_log).select(*RULE_LOG_COLS),
        )


#: Compares strings without regard to case and trailing blanks, as the base tables do.
COLLATION = "UTF8_LCASE_RTRIM"


def _one_spelling(df: DataFrame, codes: list[str]) -> DataFrame:
    """``df`` with every code of a column in that column's smallest spelling.

    A column's spellings are one aggregate (a row per code), joined back by collation; only
    codes with several spellings travel, so the join is small unless many have them.
    """
    columns = df.columns
    for c in codes:
        plain = F.collate(F.col(c), "UTF8_BINARY")
        spelled = df.groupBy(c).agg(F.min(plain).alias("_least"), F.max(plain).alias("_most")).filter("_least <> _most")
        spelled = spelled.select(F.col(c).alias("_code"), F.collate("_least", COLLATION).alias("_spelling"))
        df = df.join(spelled, F.col(c) == F.col("_code"), "left")
        df = df.select(*[F.coalesce("_spelling", c).alias(c) if c == k else F.col(k) for k in columns])
    return df


class CleanInputs:
    """The inputs with every code right-trimmed (codes were fixed-width CHAR(30), so
    trailing blanks carry no meaning).

    With ``fold_case`` codes also get a collation that ignores case, which joins, windows,
    aggregates and hashes follow from there on; they keep their spelling.  Where a column
    spells a code in several ways, the smallest spelling (by bytes) stands for all, so
    results do not depend on which row is read first.

    Rows without a customer stay; only the bucket stages leave them out.
    """

    def __init__(self, raw, fold_case: bool = False):
        self.raw, self.fold_case = raw, fold_case

    def _clean(self, df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        def code(name: str):
            if name in ("count", "node_importance", "importance"):
                return F.col(name) if name == "count" else F.rtrim(F.col(name)).alias(name)
            trimmed = F.rtrim(F.col(name))
            return (F.collate(trimmed, COLLATION) if self.fold_case else trimmed).alias(name)

        cleaned = df.select(*[code(c) for c in columns])
        codes = [c for c in columns if c not in ("count", "node_importance", "importance")]
        return _one_spelling(cleaned, codes) if self.fold_case else cleaned

    @cached_property
    def wishlist(self) -> DataFrame:
        return self._clean(self.raw.wishlist, WISHLIST_COLS)

    @cached_property
    def popularity(self) -> DataFrame:
        return self._clean(self.raw.popularity, POPULARITY_COLS)

    @cached_property
    def promotion(self) -> DataFrame:
        return self._clean(self.raw.promotion, PROMOTION_COLS)

    @cached_property
    def order_assoc(self) -> DataFrame:
        return self._clean(self.raw.order_assoc, ORDER_ASSOC_COLS)

    @cached_property
    def rule_log(self) -> DataFrame:
        return self._clean(self.raw.rule_log, RULE_LOG_COLS)
