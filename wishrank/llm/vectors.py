"""Vectors as the two embedding operators read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Vectors with a direction: not null, finite throughout, not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose rows have one length as a matrix of doubles."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (largest component first, so nothing overflows)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
