"""Operator 9: nearest neighbours by a hierarchical k-means tree and best-bin-first search.

* The tree is fitted on at most ``sample_rows`` vectors (a documented bound): k-means with
  ``branch`` centres, again within each, down to ``leaf_rows`` of the sample.  Its size
  depends on the sample alone, so it travels with the tasks.
* Every row is indexed: it goes down the tree to a leaf.
* A query visits leaves best bin first: a priority queue holds the unopened branches by
  their centre's distance, and the nearest is opened next.  How many leaves are visited is
  widened until ``recall`` is reached on trial queries against brute force, for each class
  of queries (by the size of the first leaf) on its own.  A query goes on beyond that
  number until the leaves it has opened hold ``k`` rows besides itself.
* Queries and rows of a leaf are cut into blocks, and a pair of blocks is a task's group,
  so a leaf that holds a third of all rows is spread out; each group keeps ``k`` rows per
  query, and a partial top-k closes the search.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .vectors import matrix, unit, usable


@dataclass(frozen=True)
class Settings:
    branch: int = 8
    leaf_rows: int = 48
    sample_rows: int = 20_000
    trial_queries: int = 300  # held out of the tree's sample, and at most so many more of each class
    recall: float = 0.95
    block_rows: int = 8_192
    block_queries: int = 1_024


#: A tree as plain arrays, which travel to tasks as they are: per node its centre, its first
#: child and their number, its leaf (-1: none); per leaf the rows of the sample in it.
Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def assign(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of every row of ``x`` (unit vectors)."""
    centres, first, count, leaf, _ = tree
    out = np.zeros(len(x), dtype=np.int64)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if leaf[node] >= 0:
            out[rows] = leaf[node]
            continue
        children = slice(first[node], first[node] + count[node])
        nearest = _distances(x[rows], centres[children]).argmin(axis=1)
        todo += [(int(first[node]) + k, rows[nearest == k]) for k in range(int(count[node])) if (nearest == k).any()]
    return out


def visits(tree: Tree, q: np.ndarray, limit: np.ndarray | None = None, rows: np.ndarray | None = None, need: int = 0) -> list[int]:
    """Leaves of a query, best bin first.

    ``limit`` has the number of leaves to visit by the class of the first one (``None``: all
    of them); the search goes on beyond it while the leaves hold fewer than ``need`` rows.
    """
    centres, first, count, leaf, size = tree
    heap, tie, out, held, most = [(0.0, 0, 0)], 0, [], 0, len(size)
    while heap and (len(out) < most or held < need):
        _, _, node = heapq.heappop(heap)
        if leaf[node] >= 0:
            out.append(int(leaf[node]))
            if rows is not None:
                held += int(rows[leaf[node]])
            if limit is not None and len(out) == 1:
                most = int(limit[leaf_class(size[leaf[node]])])
            continue
        children = range(int(first[node]), int(first[node] + count[node]))
        for d, child in zip(_distances(q[None, :], centres[children.start : children.stop])[0].tolist(), children):
            tie += 1
            heapq.heappush(heap, (d, tie, child))
    return out


def leaf_class(size: int) -> int:
    """Leaves by the rows of the sample in them: none or one, two or three, four to seven, ..."""
    return max(int(size), 1).bit_length() - 1


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), size=k, replace=False)]
    for _ in range(rounds):
        own = _distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        size = np.bincount(own, minlength=k)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres, _distances(x, centres).argmin(axis=1)


def build(x: np.ndarray, s: Settings, seed: int = 7) -> Tree:
    """A tree over the rows of ``x`` (unit vectors of the sample), level by level."""
    rng = np.random.default_rng(seed)
    centres, first, count, leaf, size = [np.zeros(x.shape[1])], [0], [0], [-1], []
    todo = [(0, np.arange(len(x)))]
    for node, rows in todo:  # grows while it is read
        used = np.zeros(0, dtype=np.int64)
        if len(rows) > max(s.leaf_rows, s.branch):
            found, own = _kmeans(x[rows], s.branch, rng)
            used = np.unique(own)
        if len(used) < 2:
            leaf[node] = len(size)
            size.append(len(rows))
            continue
        first[node], count[node] = len(leaf), len(used)
        for k in used:
            todo.append((len(leaf), rows[own == k]))
            centres.append(found[k])
            first.append(0)
            count.append(0)
            leaf.append(-1)
    return np.array(centres), *(np.array(c, dtype=np.int64) for c in (first, count, leaf, size))


def calibrate(tree: Tree, x: np.ndarray, held: int, k: int, s: Settings) -> np.ndarray:
    """Leaves to visit, by the class of a query's first leaf, so that ``recall`` of the ``k``
    nearest rows of ``x`` are found.

    The first ``held`` rows, which the tree was not fitted on, are trial queries, and of the
    others up to ``trial_queries`` of each class: a class that few rows belong to, such as
    that of single vectors beside large groups, has its own number.  Where a class has
    hardly any trial queries, what the worst of them needed counts; a class with none takes
    the largest number of all.
    """
    leaf = assign(tree, x)
    kinds = np.array([leaf_class(n) for n in tree[4]])[leaf]
    most = np.full(64, len(tree[4]), dtype=np.int64)
    if len(x) <= k:
        return most
    known = []
    for kind in np.unique(kinds).tolist():
        own = np.flatnonzero(kinds == kind)
        trial = own[: s.trial_queries] if len(own) <= s.trial_queries else np.concatenate([own[own < held], own[own >= held][: s.trial_queries]])
        needed = []
        for at in range(0, len(trial), 64):
            some = trial[at : at + 64]
            near = x[some] @ x.T
            near[np.arange(len(some)), some] = -np.inf
            nearest = np.argpartition(-near, k - 1, axis=1)[:, :k]
            for q, rows in zip(x[some], nearest):
                place = np.empty(len(tree[4]), dtype=np.int64)
                place[visits(tree, q)] = np.arange(1, len(tree[4]) + 1)
                needed.append(place[leaf[rows]])
        needed = np.concatenate(needed)
        few = len(trial) < 20
        most[kind] = int(needed.max() if few else np.quantile(needed, s.recall, method="higher"))
        known.append(kind)
    others = np.setdiff1d(np.arange(64), known)
    most[others] = most[known].max()
    return most


def nearest(
    rows: DataFrame,
    is_query,
    k: int = 5,
    settings: Settings = Settings(),
    scratch: Scratch | None = None,
) -> DataFrame:
    """The ``k`` nearest rows (largest cosine) of every row for which ``is_query`` holds.

    ``rows`` has vec_id and embedding; returns query_id, rank (from 1), vec_id, score.
    All rows are candidates but the query's own.  Ties go to the smaller vec_id (null
    last).  Null, zero and non-finite vectors, and those whose dimension is not the most
    common one, take no part.  Repeated rows are rows like any other.  Fewer candidates
    than ``k``: all of them.  An empty table gives no rows; other columns are ignored.
    """
    s, spark = settings, rows.sparkSession
    scratch = scratch or Scratch(spark, "ann")
    base = rows.select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("query"),
    ).filter(usable(F.col("vec")))
    base = scratch.write(base, "rows")
    dims = base.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = dims[0]["dim"], dims[0]["count"]
    base = base.filter(F.size("vec") == dim)

    draw = F.pmod(F.xxhash64("rid", F.lit(5)), F.lit(total)) < int(1.05 * s.sample_rows)
    drawn = base.filter(draw).select("rid", "vec").limit(s.sample_rows).collect()  # at most sample_rows
    sample = unit(np.array([r["vec"] for r in sorted(drawn, key=lambda r: r["rid"])], dtype=np.float64).reshape(-1, dim))
    sample = sample[np.random.default_rng(3).permutation(len(sample))]
    held = min(s.trial_queries, len(sample) // 10)
    tree = build(sample[held:], s)
    limit = calibrate(tree, sample, held, k, s)
    shared = spark.sparkContext.broadcast(tree)  # its size depends on the sample alone

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = assign(shared.value, unit(matrix(batch.column(2)))) if batch.num_rows else np.zeros(0, dtype=np.int64)
            yield pa.record_batch([*batch.columns, pa.array(leaf)], names=["rid", "vec_id", "vec", "leaf"])

    def open_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, rows = opened_by.value
            found = [visits(tree, q, limit, rows, k + 1) for q in unit(matrix(batch.column(2)))] if batch.num_rows else []
            yield pa.record_batch([*batch.columns, pa.array(found, type=pa.list_(pa.int64()))], names=["rid", "vec_id", "vec", "leaves"])

    columns = "rid long, vec_id long, vec array<double>"
    indexed = scratch.write(base.select("rid", "vec_id", "vec").mapInArrow(index, f"{columns}, leaf long"), "index")
    held_rows = np.zeros(len(tree[4]), dtype=np.int64)
    for r in indexed.groupBy("leaf").count().collect():  # at most one row per leaf
        held_rows[r["leaf"]] = r["count"]
    opened_by = spark.sparkContext.broadcast((tree, held_rows))
    asked = scratch.write(base.filter("query").select("rid", "vec_id", "vec").mapInArrow(open_leaves, f"{columns}, leaves array<long>"), "queries")
    opened = asked.select("rid", "vec_id", "vec", F.explode("leaves").alias("leaf"))

    # Blocks of a leaf: at most `leaves` rows of sizes on either side.
    blocks = (
        indexed.groupBy("leaf").agg(F.ceil(F.count("*") / s.block_rows).alias("rb"))
        .join(opened.groupBy("leaf").agg(F.ceil(F.count("*") / s.block_queries).alias("qb")), "leaf")
    )
    blocks = F.broadcast(blocks)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("rid"), F.col(n))
    columns = ["leaf", "q", "r", "asks", "rid", "vec_id", "vec"]
    left = opened.join(blocks, "leaf").select("*", own("qb").alias("q"), each("rb").alias("r"), F.lit(True).alias("asks")).select(*columns)
    right = indexed.join(blocks, "leaf").select("*", own("rb").alias("r"), each("qb").alias("q"), F.lit(False).alias("asks")).select(*columns)

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        ask, rows = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        out: list[list] = [[], [], [], [], []]
        if len(ask) and len(rows):
            x, y = (np.stack(p["vec"].to_numpy()).astype(np.float64) for p in (ask, rows))
            x, y = (m / np.abs(m).max(axis=1, keepdims=True) for m in (x, y))  # no overflow
            nx, ny = (np.sqrt(np.einsum("ij,ij->i", m, m)) for m in (x, y))
            near = (x @ y.T) / nx[:, None] / ny[None, :]
            rid, ids = rows["rid"].to_numpy(), rows["vec_id"].astype("Int64")
            order_id = ids.fillna(np.iinfo(np.int64).max).to_numpy(dtype=np.int64)
            ids = ids.to_numpy(dtype=object, na_value=None)
            for a, (qrid, qid) in enumerate(zip(ask["rid"], ask["vec_id"].astype("Int64").to_numpy(dtype=object, na_value=None))):
                line = np.where(rid == qrid, -np.inf, near[a])
                n = min(k, len(line) - int((rid == qrid).any()))
                if n <= 0:
                    continue
                # Products of one pair may differ in the last bit with its place in the
                # matrix: those near the cut are computed alike before they are ranked.
                close = np.flatnonzero(line >= np.partition(line, -n)[-n] - 1e-9)
                score = np.einsum("ij,j->i", y[close], x[a]) / (nx[a] * ny[close])
                for c in np.lexsort((rid[close], order_id[close], -score))[:n].tolist():
                    for column, v in zip(out, (qrid, qid, int(rid[close[c]]), ids[close[c]], float(score[c]))):
                        column.append(v)
        names = ["qrid", "query_id", "rid", "vec_id", "score"]
        frame = pd.DataFrame(dict(zip(names, out)))
        return frame.astype({"qrid": "int64", "query_id": "Int64", "rid": "int64", "vec_id": "Int64", "score": "float64"})

    met = left.unionByName(right).groupBy("leaf", "q", "r").applyInPandas(best, "qrid long, query_id long, rid long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("qrid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
