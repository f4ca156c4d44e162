"""Run parameters shared by every stage."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # "left" keeps wishlist rows whose category / goods has no popularity match
    # (the later script revision, the default); "inner" drops them (the first one).
    fill_mode: str = "left"
    # Best-sellers kept per (category or parent category, promotion flag).
    k: int = 40
    # List budget per customer; a customer with n indexed wishlist rows gets
    # floor(budget / n) slots per row.
    budget: int = 40
    # Wishlist rows considered per customer (the fifth bucket keeps the first five).
    max_items: int = 5
    # "text" compares importance as a string (parity), "numeric" as a number.
    importance_order: str = "text"
    # Non-parity option: buckets 2-5 also look up parent-category best-sellers
    # through each row's own parent code, as bucket 1 does.
    parent_backfill: bool = False
    # Look for hot join keys in written stages and deal their rows into pieces.
    split_hot: bool = True
    # Compare codes without regard to case (a collation; they keep their spelling).
    fold_case: bool = False
    # Non-parity option: slots that short or overlapping quotas leave unused go to the
    # customer's next best candidates, so a list has min(budget, candidates) items.
    backfill: bool = False
    # Write stage results to the checkpoint folder between pipeline phases.
    materialize: bool = True

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    def check(self) -> "Params":
        if self.fill_mode not in ("left", "inner"):
            raise ValueError(f"fill_mode must be 'left' or 'inner', got {self.fill_mode!r}")
        if self.importance_order not in ("text", "numeric"):
            raise ValueError("importance_order must be 'text' or 'numeric'")
        if self.k < 1 or self.budget < 1 or self.max_items < 1:
            raise ValueError("k, budget and max_items must be positive")
        return self


DEFAULT = Params()
