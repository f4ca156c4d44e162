"""Operator 3: near-duplicate embeddings by collision-counting projections.

Vectors of one label are projected on many random lines.  Two vectors at cosine
``threshold`` or nearer lie at most ``sqrt(2 - 2 threshold)`` apart, so on a line they
fall into each other's window (centred on either of them, ``WINDOW`` times that distance
to each side) with a probability known from the normal law.  Pairs with at least
``least_count`` collisions are verified by their cosine in double precision; the count is
calibrated so that a pair exactly at the threshold is missed with probability ``MISS``.

* Equal vectors of a label are one node with a multiplicity, so a group of copies of any
  size is one row in all that follows.
* Nodes are dealt by their place on a first line, sorted into strips as wide as its
  (wider) window: a node's window lies within its own and the two strips beside it.
  Strips are cut into tiles bounded in rows and bytes, and each pair of tiles is a
  task's group: every line is sorted there, windows are found by binary search, and
  collisions are counted per partner of one row at a time, never as rows.
* A group hands on, per node, its number of links, and a spanning forest of them instead
  of all linked pairs.  Components are joined up by alternating stars.

Comparing all rows of a label is quadratic in the label's rows by the nature of the
method (far pairs collide on a fixed share of lines); tiles bound what a task holds, and
strips skip the pairs whose first projections are apart.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import components, forest
from .vectors import matrix, unit, usable

LINES = 48
#: Half width of a window, in units of the largest distance of a linked pair.
WINDOW = 1.5
#: The same for the line that deals nodes into strips.
STRIP = 5.5
MISS = 1e-6
#: Nodes of one tile, and bytes of its vectors as doubles.
TILE = 4096
TILE_BYTES = 16 << 20
_BLOCK = 256


def collision_probability(width: float) -> float:
    """A pair at distance 1 falls into a window of half width ``width`` on a random line."""
    return math.erf(width / math.sqrt(2))


def least_count(lines: int = LINES, width: float = WINDOW, miss: float = MISS) -> int:
    """The largest count that a pair at the threshold reaches with probability 1 - miss."""
    p, below = collision_probability(width), 0.0
    for k in range(lines + 1):
        below += math.comb(lines, k) * p**k * (1 - p) ** (lines - k)
        if below > miss:
            return k
    return lines


def directions(dim: int, lines: int = LINES) -> np.ndarray:
    """Random lines of a space, the first for the strips; the same in every task."""
    return np.random.default_rng(1_000_003 + dim).standard_normal((dim, lines + 1))


def link_blocks(
    x: np.ndarray, y: np.ndarray, same: bool, threshold: float, need: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of ``x`` and ``y`` (unit vectors) that collide on at least
    ``need`` lines and have a cosine of at least ``threshold``; i < j if ``same``.

    The projections of ``y`` are sorted once per line; a row of ``x`` finds its window
    there by binary search, and its collisions are counted per partner.  A block of rows
    of ``x`` is verified and handed on at a time, so memory does not grow with the links.
    """
    half = WINDOW * math.sqrt(2 - 2 * threshold)
    lines = directions(x.shape[1])[:, 1:]
    px, py = (x @ lines).T, (y @ lines).T
    order = np.argsort(py, axis=1)
    value = np.take_along_axis(py, order, axis=1)
    for at in range(0, len(x), _BLOCK):
        end = min(len(x), at + _BLOCK)
        if same and at:  # rows before met these in their own blocks
            rest = order >= at
            order, value = (m[rest].reshape(len(m), -1) for m in (order, value))
        low = np.array([np.searchsorted(v, p[at:end] - half) for v, p in zip(value, px)]).T
        high = np.array([np.searchsorted(v, p[at:end] + half, side="right") for v, p in zip(value, px)]).T
        met = []
        for row_low, row_high in zip(low.tolist(), high.tolist()):
            window = np.concatenate([o[a:b] for o, a, b in zip(order, row_low, row_high)])
            met.append(np.flatnonzero(np.bincount(window, minlength=len(y)) >= need))
        i, j = np.repeat(np.arange(at, end), [len(m) for m in met]), np.concatenate(met)
        if same:
            i, j = i[i < j], j[i < j]
        if not len(j):
            continue
        partners, place = np.unique(j, return_inverse=True)
        near = (x[at:end] @ y[partners].T)[i - at, place] >= threshold
        yield i[near], j[near]


def linked(x: np.ndarray, y: np.ndarray, same: bool, threshold: float, need: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``link_blocks`` at once."""
    none = np.zeros(0, dtype=np.int64)
    left, right = zip((none, none), *link_blocks(x, y, same, threshold, need))
    return np.concatenate(left), np.concatenate(right)


def grown(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The forest ``root`` (per place the smallest place of its component) with pairs (i, j) added."""
    a, b = root[i], root[j]
    apart = a != b
    if not apart.any():
        return root
    return forest(len(root), np.concatenate([np.arange(len(root)), a[apart]]), np.concatenate([root, b[apart]]))


def _strips(nodes: DataFrame, threshold: float) -> DataFrame:
    wide = STRIP * math.sqrt(2 - 2 * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, dtype=np.int64)
            dims = np.array([len(v) for v in batch.column(1)])
            for d in np.unique(dims).tolist():
                k = np.flatnonzero(dims == d)
                out[k] = np.floor(unit(matrix(batch.column(1).take(pa.array(k)))) @ directions(d)[:, 0] / wide)
            yield pa.record_batch([batch.column(0), pa.array(out)], names=["node", "strip"])

    return nodes.select("node", "vec").mapInArrow(run, "node long, strip long")


def link_vectors(rows: DataFrame, threshold: float = 0.93, scratch: Scratch | None = None) -> DataFrame:
    """Per row of ``rows`` (vec_id, embedding, label): vec_id, n_links, component_id.

    Only vectors with equal labels, not null, and equal dimension are compared.
    Null, zero and non-finite vectors and rows without a label link with nothing and are
    their own component.  Repeated rows are vectors like any other: copies link with each
    other.  A component's id is its smallest vec_id; null ids count only where a component
    has no other.  Other columns are ignored; an empty table gives no rows.
    """
    scratch = scratch or Scratch(rows.sparkSession, "embed_dedup")
    base = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"), "label")
    ok = F.col("label").isNotNull() & usable(F.col("vec"))
    grouped = base.filter(ok).groupBy("label", "vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    nodes = scratch.write(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    placed = nodes.join(_strips(nodes, threshold), "node").select(
        "node", "vec", "copies", F.struct("label", F.size("vec").alias("dim")).alias("space"), "strip"
    )
    placed = scratch.write(placed, "placed")
    tile = F.least(F.lit(TILE), F.greatest(F.lit(64), F.floor(F.lit(TILE_BYTES) / (8 * F.col("space.dim")))))
    cells = placed.groupBy("space", "strip").agg(F.count("*").alias("n")).select("space", "strip", F.ceil(F.col("n") / tile).alias("tiles"))
    beside = cells.select("space", (F.col("strip") - 1).alias("strip"), F.col("tiles").alias("tiles_next"))
    before = cells.select("space", (F.col("strip") + 1).alias("strip"), F.col("tiles").alias("tiles_before"))
    dealt = (
        placed.join(cells, ["space", "strip"])
        .join(beside, ["space", "strip"], "left")
        .join(before, ["space", "strip"], "left")
        .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    )
    zero = F.lit(0).cast("long")

    def side(lhs: bool, step: int, other: str, low, high) -> DataFrame:
        """Rows as one side of the tile pairs of strips (strip, strip + step)."""
        own, far = ("i", "j") if lhs else ("j", "i")
        part = dealt.filter(F.col(other).isNotNull() & (low <= high))
        first = F.col("strip") if lhs else F.col("strip") - step
        return part.select(
            "space", first.alias("first"), F.lit(step).alias("step"), F.col("tile").alias(own),
            F.explode(F.sequence(low, high)).alias(far), "node", "vec", "copies", F.lit(lhs).alias("lhs"),
        ).select("space", "first", "step", "i", "j", "node", "vec", "copies", "lhs")

    units = (
        side(True, 0, "tiles", F.col("tile"), F.col("tiles") - 1)
        .unionByName(side(False, 0, "tiles", zero, F.col("tile") - 1))  # a tile with itself needs one side
        .unionByName(side(True, 1, "tiles_next", zero, F.col("tiles_next") - 1))
        .unionByName(side(False, 1, "tiles_before", zero, F.col("tiles_before") - 1))
    )
    need = least_count()

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        same = key[2] == 0 and key[3] == key[4]
        x = pdf[pdf["lhs"]]
        y = x if same else pdf[~pdf["lhs"]]
        if not len(x) or not len(y):
            return pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")
        a = unit(np.stack(x["vec"].to_numpy()).astype(np.float64))
        b = a if same else unit(np.stack(y["vec"].to_numpy()).astype(np.float64))
        both = (x if same else pd.concat([x, y]))[["node", "copies"]]
        node, copies, n = both["node"].to_numpy(), both["copies"].to_numpy(), len(both)
        links, root = np.zeros(n), np.arange(n)
        for i, j in link_blocks(a, b, same, threshold, need):
            j = j if same else j + len(x)
            links += np.bincount(i, weights=copies[j], minlength=n) + np.bincount(j, weights=copies[i], minlength=n)
            root = grown(root, i, j)
        k = np.flatnonzero(links)
        return pd.DataFrame({"node": node[k], "links": links[k].astype(np.int64), "root": node[root[k]]})

    keys = ["space", "first", "step", "i", "j"]
    met = scratch.write(units.groupBy(*keys).applyInPandas(compare, "node long, links long, root long"), "met")
    labels = components(met.select(F.col("node").alias("u"), F.col("root").alias("v")), scratch)
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    joined = nodes.join(labels, "node", "left").join(counts, "node", "left")
    grouped = joined.withColumn("component", F.coalesce("component", "node"))
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    known = grouped.join(smallest, "component").select(
        "label", "vec", (F.coalesce("links", zero) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    # Rows without a usable vector match nothing here, as their vector is null then.
    keyed = base.select("vec_id", "label", F.when(ok, F.col("vec")).alias("vec"))
    return keyed.join(known, ["label", "vec"], "left").select(
        "vec_id", F.coalesce("n_links", zero).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
