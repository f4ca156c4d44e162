"""Heavy hitters of join keys, found by one mergeable sketch over a written stage.

A key that holds many rows of a join's left side makes one task of the shuffle that holds
them all.  ``find_hot_keys`` aggregates a frequent-items sketch (``approx_top_k``) of each
key's hash: tasks send sketches of bounded size, no key is shuffled and at most ``KEYS``
reach the driver.  The sketch never misses a key by more than its error, about 0.001 of the
rows, and a false hit only splits a key that need not be split.

A hot key is dealt into pieces by its share of the rows, about half a task's worth each, so a
key with a third of all rows spreads over most tasks there are; only its right rows are
repeated, once per piece.  Where no key is hot, ``keyed_join`` is the plain join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Most keys that count as hot, and what the sketch keeps track of.
KEYS, TRACKED = 256, 8192
#: A key is hot from so many tasks' worth of rows on.
TASKS = 2.0


@dataclass(frozen=True)
class HotKeys:
    """Pieces by the hash of a hot key; empty: none is hot."""

    pieces: dict[int, int] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.pieces)

    def __or__(self, other: "HotKeys") -> "HotKeys":
        return HotKeys(self.pieces | other.pieces)


def key_hash(*key: Column | str) -> Column:
    """One long per key."""
    return F.xxhash64(*key)


def _collated(frame: DataFrame, key: list[Column]) -> bool:
    kinds = [f.dataType for f in frame.select(*key).schema.fields]
    return any(isinstance(k, StringType) and k.collation != "UTF8_BINARY" for k in kinds)


def find_hot_keys(frame: DataFrame, nulls: bool = False, **keys: list[Column]) -> dict[str, HotKeys]:
    """Hot keys of ``frame`` (read once, so best a written stage) for each named key.

    Shares are of the rows whose key has no null part; ``nulls`` counts the others too.
    Collated keys have no hot ones: equal spellings hash apart, so their joins stay plain and
    are left to adaptive execution.
    """
    out = {name: HotKeys() for name in keys}
    keys = {name: key for name, key in keys.items() if not _collated(frame, key)}
    if not keys:
        return out
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def known(key: list[Column]) -> Column:
        return F.lit(True) if nulls else reduce(and_, [c.isNotNull() for c in key])

    hashes = frame.select(*[F.when(known(key), key_hash(*key)).alias(name) for name, key in keys.items()])
    sketches = [
        F.struct(F.count(name).alias("rows"), F.expr(f"approx_top_k({name}, {KEYS}, {TRACKED}) FILTER (WHERE {name} IS NOT NULL)").alias("top")).alias(name)
        for name in keys
    ]
    row = hashes.agg(*sketches).first()
    for name in keys:
        total = row[name]["rows"]
        least = max(TASKS / tasks, 1 / KEYS) * total
        hot = [(r["item"], r["count"]) for r in row[name]["top"] or [] if r["count"] >= least and r["count"] > 1]
        out[name] = HotKeys({h: min(tasks, math.ceil(2 * n * tasks / total)) for h, n in hot if tasks > 1})
    return out
