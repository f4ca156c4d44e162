"""Data-quality checks over the inputs and the results.

One row per check: (check, value).  Each frame is read once: the wishlist by one
grouped count, the filled set and the final lists by one aggregate each.  That a result
equals its distinct rows is checked for the candidates of every bucket and the final lists,
by the fingerprints of ``functions.fingerprint``: the number of repeated rows, or -1 where
the counts agree and the contents do not.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import distinct_check

if TYPE_CHECKING:
    from ..plans.recommend import Recommender

CODE_MAX_LEN = 30  # codes are CHAR(30) in the base tables
CUSTOMER_MAX_LEN = 20  # the flat result holds customers of at most 20 characters


def coverage_checks(rec: "Recommender") -> DataFrame:
    copies = F.col("n")
    long = lambda c, n: F.coalesce(F.length(c) > n, F.lit(False))
    overlong = long("cust_no", CODE_MAX_LEN) | long("goods_code", CODE_MAX_LEN) | long("category_code", CODE_MAX_LEN)
    rows = rec.inputs.wishlist.groupBy("cust_no", "goods_code", "category_code").agg(F.count(F.lit(1)).alias("n"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, copies)), F.lit(0))
    wish = rows.agg(
        total(F.col("cust_no").isNull()).alias("null_customers"),
        total(overlong).alias("overlong_codes"),
        total(long("cust_no", CUSTOMER_MAX_LEN)).alias("overlong_customers"),
        F.count_distinct("cust_no").alias("wishlist_customers"),
        F.count(F.lit(1)).alias("wishlist_distinct_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("repeated_wishlist_rows"),
    )
    filled = rec.wishlist_set.agg(
        F.count_distinct("custno").alias("filled_customers"), F.count(F.lit(1)).alias("filled_distinct_rows")
    )
    over = F.when(F.col("recomdcount") > rec.params.budget, 1)
    final = rec.final.agg(F.count(F.lit(1)).alias("listed_customers"), F.count(over).alias("lists_over_budget"))
    # Every listed customer has a filled row, so those without a list are the difference
    # of two counts.  A dozen one-value rows are added up at the end.
    filled = filled.withColumn("customers_without_list", F.col("filled_customers"))
    final = final.withColumn("customers_without_list", -F.col("listed_customers"))

    def spread(frame: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("check"), F.col(c).cast("bigint").alias("value")) for c in frame.columns]
        return frame.select(F.explode(F.array(*pairs)).alias("p")).select("p.check", "p.value")

    repeated = F.when(F.col("same"), F.lit(0)).when(F.col("repeated_rows") > 0, F.col("repeated_rows")).otherwise(F.lit(-1))
    buckets = distinct_check(rec.bucket_candidates_full(), by="bucket")
    line = lambda what, value: F.struct(F.concat(F.lit("bucket"), F.col("bucket"), F.lit(what)).alias("check"), value.cast("long").alias("value"))
    pairs = F.array(line("_candidates", F.col("rows")), line("_candidates_repeated", repeated))
    per_bucket = buckets.select(F.explode(pairs).alias("p")).select("p.check", "p.value")
    lists = distinct_check(rec.final).select(repeated.cast("long").alias("lists_repeated"))
    rows = spread(wish).unionByName(spread(filled)).unionByName(spread(final)).unionByName(spread(lists))
    return rows.groupBy("check").agg(F.sum("value").alias("value")).unionByName(per_bucket)
