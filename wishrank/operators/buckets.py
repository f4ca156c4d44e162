"""Share the list budget across each customer's wishlist rows.

A customer with n distinct filled rows is in bucket min(n, max_items); bucket
b keeps the first b rows (by goods, category, parent; NULLs first), numbers
them 1..b (goodindex), and each row may contribute floor(budget / b) items.

Candidates of an indexed row r of customer c (the same rows as joins of
customer and goods, or customer and category, against the full candidate tables):

* association: every association item of r's goods;
* category best-sellers of r's category, unless every filled row of c in
  that category has one and the same goods g, in which case g itself is left
  out;
* parent best-sellers looked up by r's **category** code (the code
  column is overloaded and always joined to the category), under the same rule for c's
  rows with that parent code.  Bucket 1 joins on the customer alone, so there
  the lookup also uses r's own parent code.

"one and the same goods" is read off a per (customer, level, code) min/max of
goods, a partial aggregate, so no customer's rows are ever gathered in one
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hot_keys import HotKeys
from ..functions.joins import dealt, keyed_join
from ..functions.ordering import CATEGORY_IMPORTANCE, falling, falling_text, importance_key
from ..params import Params
from .candidates import CAT, P2, code_summaries, level_keys

CAND_COLS = ("custno", "bucket", "goodindex", "recomdlist", "discounttype", "importance")


def wishlist_buckets(wset: DataFrame, params: Params) -> DataFrame:
    """(custno, wishlist_rows, bucket) per customer."""
    return wset.filter(F.col("custno").isNotNull()).groupBy("custno").agg(F.count(F.lit(1)).alias("wishlist_rows")).select(
        "custno",
        "wishlist_rows",
        F.least(F.col("wishlist_rows"), F.lit(params.max_items)).cast("int").alias("bucket"),
    )


def wishlist_index(wset: DataFrame, params: Params) -> DataFrame:
    """The rows each bucket keeps, with goodindex and bucket.

    One ``row_number() <= max_items`` per customer (a partial top-k before the
    shuffle, so a customer with millions of rows ships at most ``max_items``
    per map task); the bucket is then the number of rows kept, which is
    min(n, max_items), counted over the same partitioning.
    """
    w = Window.partitionBy("custno").orderBy("goodscode", "catecode", "p2code")
    kept = (
        wset.filter(F.col("custno").isNotNull())
        .withColumn("goodindex", F.row_number().over(w))
        .filter(F.col("goodindex") <= params.max_items)
    )
    return kept.withColumn(
        "bucket", F.count(F.lit(1)).over(Window.partitionBy("custno")).cast("int")
    )


def _lookups(indexed: DataFrame, params: Params) -> DataFrame:
    """(custno, bucket, goodindex, level, key): the lists each indexed row reads."""
    own_parent = F.col("bucket") == 1
    if params.parent_backfill:
        own_parent = F.lit(True)
    return (
        indexed.select(
            "custno",
            "bucket",
            "goodindex",
            level_keys(
                (CAT, F.col("catecode")),
                (P2, F.col("catecode")),
                # A code that is both is read once.
                (P2, F.when(own_parent & ~F.col("p2code").eqNullSafe(F.col("catecode")), F.col("p2code"))),
            ),
        )
        .select("custno", "bucket", "goodindex", "lk.level", "lk.key")
        .filter(F.col("key").isNotNull())
    )


def quota(bucket_col: str, params: Params):
    """Items a row of this bucket may contribute: floor(budget / bucket)."""
    return F.floor(F.lit(params.budget) / F.col(bucket_col))


def bucket_candidates(
    indexed: DataFrame,
    wset: DataFrame,
    assoc: DataFrame,
    bind: DataFrame,
    params: Params,
    cut: bool = False,
    hot: dict[str, HotKeys] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """(custno, bucket, goodindex, recomdlist, discounttype, importance), distinct.

    With ``cut=False`` this is the full candidate table (``assoc``
    is the full per-goods association table).  With ``cut=True`` ``assoc`` is
    ``assoc_best_top`` and each row only takes entries that can still make its
    quota q (with ``backfill``: the whole budget): association entries at position <= q
    of their goods' list, and best-seller entries at position <= q + 1 of their list (an
    entry further down has q + 1 entries ahead of it, at most one of which, the row's
    own goods, is skipped).  Every stage after ``best_per_item`` is unchanged;
    the cut table is not de-duplicated (``best_per_item`` ignores repeats).

    With ``tasks`` the lookups are dealt before best-seller lists are spelled out, those of the
    full table by customer: where the lists are broadcast, it is de-duplicated and grouped
    in place, and only lookups and association rows are shuffled.
    """
    hot = hot or {}
    reach = F.lit(params.budget) if params.backfill else quota("bucket", params)
    rows = indexed.select("custno", "bucket", "goodindex", "goodscode").filter(F.col("goodscode").isNotNull())
    acols = ["goodscode", "recomdlist", "discounttype", "importance"] + (["pos"] if cut else [])
    by_assoc = keyed_join(rows, assoc.select(*acols), ["goodscode"], "inner", hot.get("goods"))
    if cut:
        by_assoc = by_assoc.filter(F.col("pos") <= reach)
    by_assoc = by_assoc.select(*CAND_COLS) if cut else dealt(by_assoc.select(*CAND_COLS), tasks, "custno")

    looks = _lookups(indexed, params).join(code_summaries(wset), ["custno", "level", "key"], "inner")
    # The cut rows are shuffled by customer when they are spelled out, so that partitions follow their size.
    looks = dealt(looks, tasks, "custno", *["goodindex"] * cut)
    b = bind.filter(F.col("recomdlist").isNotNull()).select(
        "level", F.col("catecode").alias("key"), "recomdlist", "discounttype", "pos"
    )
    by_best = keyed_join(looks, b, ["level", "key"], "inner", hot.get("lists"))
    if cut:
        by_best = by_best.filter(F.col("pos") <= reach + 1)
    by_best = (
        by_best.filter(~((F.col("gmin") == F.col("gmax")) & (F.col("gmin") == F.col("recomdlist"))))
        .select(
            "custno",
            "bucket",
            "goodindex",
            "recomdlist",
            "discounttype",
            F.lit(CATEGORY_IMPORTANCE).alias("importance"),
        )
    )
    both = by_assoc.unionByName(by_best)
    # The cut path feeds best_per_item, a max per item, which ignores repeats.
    return both if cut else both.distinct()


#: Fields of an entry, in the order that lists have.
ENTRY = ("discounttype", "falling", "recomdlist", "importance")


def _entry(code: Column, importance: Column, item: Column) -> Column:
    """An entry with its code, its importance and its item from three structs."""
    fields = zip(ENTRY, (code, importance, item, importance))
    return F.struct(*[source[f].alias(f) for f, source in fields])


def entry_lists(rows: DataFrame, by: list[str], params: Params) -> DataFrame:
    """(*by, entries): one row per list of ``rows``, its entries in (code, importance desc, item) order.

    Entries are structs that sort so by themselves.  ``rows`` are cut: a list has at most
    2 * k or ``budget`` of them.
    """
    entry = F.struct("discounttype", falling(F.col("importance"), params).alias("falling"), "recomdlist", "importance")
    return rows.groupBy(*by).agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def best_lists(bind: DataFrame, params: Params) -> DataFrame:
    """(level, key, entries): every best-seller list as far as any row reads it."""
    reached = bind.filter(F.col("recomdlist").isNotNull() & (F.col("pos") <= params.budget + 1))
    rows = reached.select("level", F.col("catecode").alias("key"), "recomdlist", "discounttype", F.lit(CATEGORY_IMPORTANCE).alias("importance"))
    return entry_lists(rows, ["level", "key"], params)


def row_entries(
    indexed: DataFrame,
    wset: DataFrame,
    assoc: DataFrame,
    best: DataFrame,
    params: Params,
    hot: dict[str, HotKeys] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """(custno, bucket, goodindex, entries): ``bucket_candidates`` with ``cut``, a row per list.

    ``assoc`` (by goodscode) and ``best`` (by level and key) are ``entry_lists``.  An indexed
    row has at most four lists, so a row per list is all that joins and the shuffle by
    customer carry; the cuts are those of ``bucket_candidates``.
    """
    hot = hot or {}
    reach = F.lit(params.budget) if params.backfill else quota("bucket", params)
    rows = indexed.select("custno", "bucket", "goodindex", "goodscode").filter(F.col("goodscode").isNotNull())
    by_assoc = keyed_join(rows, assoc, ["goodscode"], "inner", hot.get("goods"))
    by_assoc = by_assoc.select("custno", "bucket", "goodindex", F.slice("entries", F.lit(1), reach.cast("int")).alias("entries"))

    looks = _lookups(indexed, params).join(code_summaries(wset), ["custno", "level", "key"], "inner")
    looks = dealt(looks, tasks, "custno", "goodindex")
    by_best = keyed_join(looks, best, ["level", "key"], "inner", hot.get("lists"))
    reached = F.slice("entries", F.lit(1), (reach + 1).cast("int"))
    others = F.filter(reached, lambda e: e["recomdlist"] != F.col("gmin"))
    mine = F.when(F.col("gmin") == F.col("gmax"), others).otherwise(reached)
    by_best = by_best.select("custno", "bucket", "goodindex", mine.alias("entries"))
    return by_assoc.unionByName(by_best).filter(F.size("entries") > 0)


def _firsts(*fields: str) -> Column:
    """Per item of ``entries`` a struct of the item and its least ``fields``, by item."""
    by_item = F.sort_array(F.transform("entries", lambda e: F.struct(e["recomdlist"], *[e[f] for f in fields])))
    # The sorted array is a variable of its own, so no optimizer rule can sort it anew for each entry.
    once = lambda a: F.filter(a, lambda e, i: ~e["recomdlist"].eqNullSafe(F.get(a, i - 1)["recomdlist"]))
    return F.get(F.transform(F.array(by_item), once), F.lit(0))


def _all_once() -> Column:
    """No item of ``entries`` comes twice."""
    return F.size(F.array_distinct(F.col("entries")["recomdlist"])) == F.size("entries")


def ranked_entries(lists: DataFrame, params: Params) -> DataFrame:
    """(custno, bucket, goodindex, entries): P18-P19, each item of a row once, as many as it may bring, ranked.

    ``lists`` is ``row_entries``, by customer.  A row has some hundred entries at most, so
    its items are made distinct and ranked inside its array, as ``best_per_item`` and
    ``quota_topk`` do over rows.
    """
    reach = F.lit(params.budget) if params.backfill else quota("bucket", params)
    rows = lists.groupBy("custno", "bucket", "goodindex").agg(F.flatten(F.collect_list("entries")).alias("entries"))
    best = F.transform(_firsts("discounttype", "falling", "importance"), lambda e: _entry(e, e, e))
    ranked = F.sort_array(F.when(_all_once(), F.col("entries")).otherwise(best))
    return rows.filter(reach >= 1).withColumn("entries", F.slice(ranked, F.lit(1), reach.cast("int")))


def merged_entries(ranked: DataFrame, params: Params) -> DataFrame:
    """(custno, entries): P20, each item of a customer once, in the order of the final list.

    An item has its lowest code and its highest importance.  With ``backfill`` it also has
    its best rank in any row, and the budget goes to the lowest ranks first (see
    ``backfilled_items``).  ``ranked`` is ``ranked_entries``; a customer has at most ``budget``
    of them, with ``backfill`` budget x max_items.
    """
    entries = F.col("entries")
    ties = params.importance_order == "numeric"  # numbers written in two ways: the greater text
    if params.backfill or ties:
        more = lambda e, i: F.struct(*[e[f].alias(f) for f in ENTRY], falling_text(e["importance"]).alias("tie"), i.alias("rank"))
        entries = F.transform(entries, more)
    whole = ranked.select("custno", entries.alias("entries")).groupBy("custno").agg(F.flatten(F.collect_list("entries")).alias("entries"))
    merged = F.zip_with(_firsts("discounttype"), _firsts("falling", *["tie"] * ties, "importance"), lambda c, m: _entry(c, m, c))
    if params.backfill:
        rising = F.sort_array(F.zip_with(_firsts("rank"), merged, lambda r, m: F.struct(r["rank"].alias("rank"), *[m[f].alias(f) for f in ENTRY])))
        merged = F.transform(F.slice(rising, 1, params.budget), lambda e: _entry(e, e, e))
    elif not ties:
        merged = F.when(_all_once(), F.col("entries")).otherwise(merged)
    return whole.select("custno", F.sort_array(merged).alias("entries"))


def best_per_item(cands: DataFrame, params: Params) -> DataFrame:
    """Each (customer, goodindex, item) once: lowest code, then highest importance."""
    key = importance_key("importance", params)
    return cands.groupBy("custno", "bucket", "goodindex", "recomdlist").agg(
        F.max(
            F.struct((-F.col("discounttype")).alias("nc"), key.alias("ik"), F.col("importance").alias("imp"))
        ).alias("b")
    ).select(
        "custno",
        "bucket",
        "goodindex",
        "recomdlist",
        (-F.col("b.nc")).cast("int").alias("discounttype"),
        F.col("b.imp").alias("importance"),
    )


def quota_topk(best: DataFrame, params: Params) -> DataFrame:
    """Per (customer, goodindex) the first floor(budget / bucket) items
    by (code, importance desc, item).

    The literal ``<= budget`` lets the planner cut each group map-side before
    the shuffle; the per-bucket quota is applied right after.
    """
    key = importance_key("importance", params)
    w = Window.partitionBy("custno", "bucket", "goodindex").orderBy(
        F.col("discounttype"), key.desc(), F.col("recomdlist")
    )
    return (
        best.withColumn("_rn", F.row_number().over(w))
        .filter((F.col("_rn") <= params.budget) & (F.col("_rn") <= quota("bucket", params)))
        .drop("_rn")
    )


def backfilled_items(best: DataFrame, params: Params) -> DataFrame:
    """P19-P20 with unused quota poured into the customer's next best candidates.

    Every indexed row ranks its items, and water rises over all of a customer's rows at
    once: an item comes in at its best rank in any of them, until the budget is reached.
    The quota lists are that water up to rank floor(budget / bucket), so their items always
    come first; what overlaps and short rows left unused goes to the ranks above.  An item
    has its lowest code and highest importance over the rows that rank it within the budget.
    Two windows over the customer's partition, at most budget x max_items rows each.
    """
    key = importance_key("importance", params)
    own = Window.partitionBy("custno", "bucket", "goodindex").orderBy(F.col("discounttype"), key.desc(), F.col("recomdlist"))
    ranked = best.withColumn("_rank", F.row_number().over(own)).filter(F.col("_rank") <= params.budget)
    merged = ranked.groupBy("custno", "recomdlist").agg(
        F.min("_rank").alias("_level"),
        F.min("discounttype").alias("discounttype"),
        F.max(F.struct(key.alias("ik"), F.col("importance").alias("imp"))).alias("m"),
    )
    rising = Window.partitionBy("custno").orderBy("_level", "discounttype", F.desc("m.ik"), "recomdlist")
    poured = merged.withColumn("_rn", F.row_number().over(rising)).filter(F.col("_rn") <= params.budget)
    return poured.select("custno", "recomdlist", "discounttype", F.col("m.imp").alias("importance"))


def merge_items(quota: DataFrame, params: Params) -> DataFrame:
    """P20: each (customer, item) once, with its lowest code and highest importance."""
    key = importance_key("importance", params)
    return quota.groupBy("custno", "recomdlist").agg(
        F.min("discounttype").alias("discounttype"),
        F.max(F.struct(key.alias("ik"), F.col("importance").alias("imp"))).alias("m"),
    ).select("custno", "recomdlist", "discounttype", F.col("m.imp").alias("importance"))
