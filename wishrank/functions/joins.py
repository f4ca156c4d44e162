"""Equi-joins that stay balanced when one key of the left side is hot.

Whether a side is broadcast is left to the planner and, from the sizes of written shuffle
files, to adaptive execution; ``keyed_join`` never forces a side.  Keys that a sketch of the left side
found hot (``hot_keys``) are dealt into pieces: each of their left rows goes to one piece by
a hash of the whole row, and their right rows are repeated once per piece.  All other keys
have one piece, and without a hot key the join is a plain one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hot_keys import HotKeys, key_hash

_SALT, _HASH, _PIECES = "_wr_salt", "_wr_hash", "_wr_pieces"


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` in exactly ``tasks`` partitions by ``keys``; without ``tasks``, as it is.

    For rows that a later join turns into many: adaptive execution sizes partitions by the
    few bytes before that join, so it must not merge them.
    """
    return df.repartition(tasks, *keys) if tasks else df


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join on the columns ``on``: columns of ``left``, then the other columns of ``right``.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.  ``hot`` holds the hot keys
    of ``left`` (null ones too), by the hash of ``on`` in this order.  The rows of a hot key
    must not all be equal; callers with repeated whole rows join their counts.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    on, columns = list(on), list(left.columns)
    rest = [c for c in right.columns if c not in on] if how in ("inner", "left") else []
    if hot:
        # At most hot_keys.KEYS rows.
        pieces = F.broadcast(left.sparkSession.createDataFrame(list(hot.pieces.items()), f"{_HASH} long, {_PIECES} int"))
        n = F.coalesce(_PIECES, F.lit(1))
        left = left.join(pieces, key_hash(*on) == F.col(_HASH), "left")
        left = left.select(*columns, F.pmod(F.xxhash64(*columns), n).cast("int").alias(_SALT))
        own = list(right.columns)
        right = right.join(pieces, key_hash(*on) == F.col(_HASH), "left")
        right = right.select(*own, F.explode(F.sequence(F.lit(0), n - 1)).alias(_SALT))
        on = [*on, _SALT]
    return left.join(right, on, how).select(*columns, *rest)
