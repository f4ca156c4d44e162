"""End-to-end plans: quota lists (E1), flat lists (E2), filled wishlist.

``Recommender`` holds one run's inputs and parameters and exposes every stage
as a DataFrame.  Building one runs no job but one sketch of hot join keys per stage that
needs it and the writes of the stages it shares with others (inputs derived from driver tables, popularity weights, filled wishlist set,
association and best-seller lists), each once per run; the rest is a lazy plan for
Catalyst.

Shuffle plan of the quota lists, per phase:

* fill: wishlist distinct (by row), then joins to the category map and the
  goods picks;
* per-goods association: one join to the per-goods flag table, one
  (goods, item) aggregate, one partial top-k per goods;
* best-sellers: one window per (code, promotion flag) with a partial top-k;
* index: one partial top-5 per customer;
* candidates: joins (hot keys in pieces) to per-goods lists and best-seller lists, a join to
  per-code summaries; one grouped array per (customer, row), ranked and cut; one per customer,
  merged and listed.
"""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hot_keys import HotKeys, find_hot_keys
from ..operators import buckets, candidates, checks, fill, flat, lists, promo
from ..params import DEFAULT, Params
from ..sources.inputs import DERIVED_FROM, CleanInputs, DerivedInputs, Inputs
from ..sources.tables import table_path
from .stages import Stager


#: Filled wishlist rows whose best-seller lists one task spells out (up to 4 * k entries each).
ROWS_PER_TASK = 10_000
#: Best-seller entries that are broadcast to where rows stand by customer; beyond, the planner decides.
BROADCAST_ENTRIES = 500_000


class Recommender:
    def __init__(
        self,
        spark: SparkSession,
        inputs: Inputs | DerivedInputs,
        params: Params = DEFAULT,
        stager: Stager | None = None,
    ):
        self.spark = spark
        self.params = params.check()
        self.stage = stager or Stager(spark, params)
        self.raw = inputs

    @classmethod
    def from_sf_dir(cls, spark: SparkSession, sf_dir: str, params: Params = DEFAULT, resume: bool = False) -> "Recommender":
        """A run over inputs derived from driver tables (staged with the run's stages).

        With ``resume`` stages that an earlier, cut-off run over the same files with the same
        parameters has finished are read instead of written.
        """
        paths = [table_path(sf_dir, t) for t in DERIVED_FROM]
        stager = Stager.resumable(spark, params, paths) if resume else Stager(spark, params)
        return cls(spark, DerivedInputs(spark, sf_dir, params, stager), params, stager)

    @classmethod
    def resumable(cls, spark: SparkSession, inputs: Inputs, params: Params = DEFAULT) -> "Recommender":
        """A run over tables kept in files (``catalog_inputs``) that resumes like the above."""
        frames = (inputs.wishlist, inputs.popularity, inputs.promotion, inputs.order_assoc, inputs.rule_log)
        return cls(spark, inputs, params, Stager.resumable(spark, params, [p for df in frames for p in df.inputFiles()]))

    def close(self) -> None:
        """Delete the stages of this run; its frames cannot be read afterwards."""
        self.stage.close()

    # ---------------------------------------------------------------- inputs
    @cached_property
    def inputs(self) -> CleanInputs:
        return CleanInputs(self.raw, self.params.fold_case)

    # -------------------------------------------- hot keys of written stages
    def _hot(self, frame, nulls: bool = False, **keys) -> dict[str, HotKeys]:
        look = self.params.split_hot and self.params.materialize
        return find_hot_keys(frame(), nulls, **keys) if look else {}

    @cached_property
    def hot_popularity(self) -> dict[str, HotKeys]:
        return self._hot(lambda: self.inputs.popularity, nulls=True, goods=[F.col("goods_code")])

    @cached_property
    def hot_wishlist(self) -> dict[str, HotKeys]:
        """Of the rows that each join reads: those with a category, and those without."""
        known = F.col("category_code").isNotNull()
        goods = F.when(~known, F.col("goods_code"))
        return self._hot(lambda: self.inputs.wishlist, category=[F.col("category_code")], goods=[goods])

    @cached_property
    def hot_rules(self) -> dict[str, HotKeys]:
        i = self.inputs
        return self._hot(lambda: candidates.assoc_rules(i.order_assoc, i.rule_log), item=[F.col("recomdlist")])

    @cached_property
    def hot_set(self) -> dict[str, HotKeys]:
        look = self.params.split_hot and self.params.materialize
        return candidates.hot_keys_of_set(self.wishlist_set) if look else {}

    # ------------------------------------------------- sizes of written stages
    @cached_property
    def tasks(self) -> int | None:
        """Tasks that spell out the lists of all filled rows: in proportion to the rows."""
        if not self.params.materialize:
            return None
        return max(self.spark.sparkContext.defaultParallelism, math.ceil(self.wishlist_set.count() / ROWS_PER_TASK))

    @cached_property
    def few_lists(self) -> bool:
        return self.params.materialize and self.binding.count() <= BROADCAST_ENTRIES

    @property
    def lists(self) -> DataFrame:
        """The best-seller lists, with a hint where they are few: at most 2 * k entries per code."""
        return F.broadcast(self.binding) if self.few_lists else self.binding

    @property
    def hot_lists(self) -> HotKeys | None:
        """Hot lists matter only where the lists are not broadcast."""
        return None if self.few_lists else self.hot_set.get("lists")

    # ------------------------------------------------------ promotion
    def promo_flag(self) -> DataFrame:
        i = self.inputs
        return promo.promo_flag(i.popularity, i.promotion, self.hot_popularity.get("goods"))

    @cached_property
    def weighted(self) -> DataFrame:
        i = self.inputs
        return self.stage(promo.weighted_popularity(i.popularity, i.promotion, self.hot_popularity.get("goods")), "weighted")

    @cached_property
    def flags(self) -> DataFrame:
        return promo.goods_flag(self.weighted)

    # ------------------------------------------------------------ fill
    def wishlist_distinct(self) -> DataFrame:
        return fill.wishlist_distinct(self.inputs.wishlist)

    def category_parent_map(self) -> DataFrame:
        src = fill.fill_source(self.inputs.wishlist, self.params)
        return fill.category_parent_map(src, self.inputs.popularity, self.params)

    def fill_parent(self) -> DataFrame:
        src = fill.fill_source(self.inputs.wishlist, self.params)
        return fill.fill_parent(src, self.category_parent_map(), self.hot_wishlist.get("category"))

    def fill_category(self) -> DataFrame:
        src = fill.fill_source(self.inputs.wishlist, self.params)
        return fill.fill_category(src, self.inputs.popularity, self.params, self.hot_wishlist.get("goods"))

    def filled_wishlist(self) -> DataFrame:
        return fill.filled_wishlist(self.inputs.wishlist, self.inputs.popularity, self.params, self.hot_wishlist)

    @cached_property
    def wishlist_set(self) -> DataFrame:
        i = self.inputs
        return self.stage(fill.filled_set(i.wishlist, i.popularity, self.params, self.hot_wishlist), "wishlist_set")

    # ------------------------------------------------------ candidates
    @cached_property
    def assoc(self) -> DataFrame:
        i = self.inputs
        rules = candidates.assoc_rules(i.order_assoc, i.rule_log)
        return self.stage(candidates.assoc_by_goods(rules, self.flags, self.hot_rules.get("item")), "assoc")

    def assoc_candidates(self) -> DataFrame:
        return candidates.assoc_candidates(self.wishlist_set, self.assoc, self.hot_set.get("goods"))

    @cached_property
    def binding(self) -> DataFrame:
        return self.stage(candidates.binding(self.weighted, self.wishlist_set, self.params), "binding")

    def bestsellers(self, level: str) -> DataFrame:
        return self.binding.filter(self.binding.level == level).drop("level", "pos")

    def category_candidates(self) -> DataFrame:
        return candidates.category_candidates(self.wishlist_set, self.lists, self.hot_lists, self.tasks)

    # ---------------------------------------------------------- flat
    def flat_candidates(self) -> DataFrame:
        return flat.flat_candidates(self.assoc_candidates(), self.category_candidates())

    @cached_property
    def flat_topk(self) -> DataFrame:
        # Association rows limited per goods first (exact, see assoc_flat_top).
        top = self.stage(candidates.assoc_flat_top(self.assoc, self.params), "assoc_flat_top")
        bind = candidates.flat_binding(self.lists, self.params)
        hot = self.hot_set | {"lists": self.hot_lists}
        cands = flat.flat_candidates_cut(self.wishlist_set, top, bind, self.params, hot, self.tasks)
        return flat.flat_topk(cands, self.params)

    def flat_result(self) -> DataFrame:
        return flat.flat_result(self.flat_topk)

    # ------------------------------------------------------- buckets
    def wishlist_buckets(self) -> DataFrame:
        return buckets.wishlist_buckets(self.wishlist_set, self.params)

    @cached_property
    def indexed(self) -> DataFrame:
        return buckets.wishlist_index(self.wishlist_set, self.params)

    def bucket_candidates_full(self) -> DataFrame:
        """The full candidate tables of all buckets together."""
        return buckets.bucket_candidates(
            self.indexed, self.wishlist_set, self.assoc, self.lists, self.params, hot=self.hot_set | {"lists": self.hot_lists}, tasks=self.tasks
        )

    @cached_property
    def bucket_entries(self) -> DataFrame:
        """Candidates cut to what each row's quota can still use (exact for
        every later stage), a row per list, shuffled once by customer.

        After the cut a customer in bucket b has b rows with at most q
        association and 3 * (q + 1) best-seller entries each (q = budget // b),
        at most 175 for the default budget (with ``backfill`` q = budget, so at most 815),
        so even the largest customer fits one task; best-per-item,
        quota, merge and the final list all group by customer first and run
        on this partitioning without another shuffle.
        """
        top = buckets.entry_lists(candidates.assoc_best_top(self.assoc, self.params), ["goodscode"], self.params)
        top = self.stage(top, "assoc_best_top")
        best = buckets.best_lists(self.binding, self.params)
        best = F.broadcast(best) if self.few_lists else best
        hot = self.hot_set | {"lists": self.hot_lists}
        return buckets.row_entries(self.indexed, self.wishlist_set, top, best, self.params, hot, self.tasks).repartition("custno")

    def best_per_item(self, full: bool = True) -> DataFrame:
        """P18 over the full candidate tables (``full``) or the cut ones."""
        if full:
            return buckets.best_per_item(self.bucket_candidates_full(), self.params)
        cands = self.bucket_entries.select("custno", "bucket", "goodindex", F.explode("entries").alias("e"))
        cands = cands.select("custno", "bucket", "goodindex", "e.recomdlist", "e.discounttype", "e.importance")
        return buckets.best_per_item(cands, self.params)

    def ranked_entries(self) -> DataFrame:
        return buckets.ranked_entries(self.bucket_entries, self.params)

    def merged_entries(self) -> DataFrame:
        return buckets.merged_entries(self.ranked_entries(), self.params)

    def quota_topk(self) -> DataFrame:
        ranked = self.ranked_entries()
        if self.params.backfill:  # rows are ranked up to the budget there
            ranked = ranked.withColumn("entries", F.slice("entries", F.lit(1), buckets.quota("bucket", self.params).cast("int")))
        return ranked.select("custno", "bucket", "goodindex", F.explode("entries").alias("e")).select(
            "custno", "bucket", "goodindex", "e.recomdlist", "e.discounttype", "e.importance"
        )

    def merge_items(self) -> DataFrame:
        return self.merged_entries().select("custno", F.explode("entries").alias("e")).select(
            "custno", "e.recomdlist", "e.discounttype", "e.importance"
        )

    # ---------------------------------------------------------- lists
    def final_lists(self) -> DataFrame:
        return lists.listed(self.merged_entries())

    @cached_property
    def final(self) -> DataFrame:
        """The final lists as a written stage, for those who read them more than once."""
        return self.stage(self.final_lists(), "final")

    def recomdcount_histogram(self) -> DataFrame:
        return lists.recomdcount_histogram(self.final_lists())

    def coverage_checks(self) -> DataFrame:
        return checks.coverage_checks(self)
