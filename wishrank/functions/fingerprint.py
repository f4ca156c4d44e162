"""Order-free fingerprints of row multisets, and the check that a result has no repeats.

A fingerprint is a count and the sums of two 64-bit row hashes, so it does not depend on
order or partitions and adds up over disjoint parts.  Equal multisets have equal
fingerprints; different ones agree with a probability of about 2 ** -128.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row; which columns are null counts as well."""
    null_mask = F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    own = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(null_mask, *own), F.xxhash64(F.lit(7), *own, null_mask)


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


@dataclass(frozen=True)
class Fingerprint:
    rows: int
    first: int
    second: int


def fingerprint(df: DataFrame) -> Fingerprint:
    """One aggregate over ``df``; nothing is shuffled but one row per task."""
    a, b = row_hashes(df.columns)
    row = df.agg(F.count(F.lit(1)), _total(a), _total(b)).first()
    return Fingerprint(int(row[0]), int(row[1]), int(row[2]))


def distinct_check(df: DataFrame, by: str | None = None) -> DataFrame:
    """(``by``,) rows, repeated_rows and ``same``: is ``df`` equal to its distinct rows?

    Rows are grouped once with their counts; the fingerprint of all rows (each group as often
    as it occurs) is held against that of the groups.  A row that very many share is one
    partial count per task.  With ``by``, one line per value of that column.
    """
    a, b = row_hashes(df.columns)
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    groups = groups.select(*([F.col(by)] if by else []), "_n", a.alias("_a"), b.alias("_b"))
    n = F.col("_n").cast("decimal(20,0)")
    of_all = F.struct(F.coalesce(F.sum("_n"), F.lit(0)), _total(F.col("_a") * n), _total(F.col("_b") * n))
    of_distinct = F.struct(F.count(F.lit(1)), _total(F.col("_a")), _total(F.col("_b")))
    facts = [
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("repeated_rows"),
        (of_all == of_distinct).alias("same"),
    ]
    return groups.groupBy(by).agg(*facts) if by else groups.agg(*facts)
