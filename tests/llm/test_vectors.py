"""Embedding dedup and nearest neighbours against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wishrank.llm import ann, embed_dedup
from wishrank.llm.components import forest

SCHEMA = "vec_id long, embedding array<float>, label int, strip string, node long"


def vectors(seed: int = 1, n: int = 300, dim: int = 16):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((6, dim))
    rows = []
    for k in range(n):
        v = centre[k % 6] + rng.standard_normal(dim) * rng.choice([0.05, 0.2, 0.35, 2.0])
        rows.append((k, v.astype(np.float32).tolist(), int(k % 6 // 2)))
    rows += [(1000 + k, rows[7][1], rows[7][2]) for k in range(20)]  # copies
    rows += [(1100, rows[7][1], 2 - rows[7][2]), (1101, [2 * x for x in rows[7][1]], rows[7][2]), (1102, rows[7][1], None)]
    rows += [(1200, None, 1), (1201, [0.0] * dim, 1), (1202, [float("nan")] * dim, 1), (1203, [float("inf")] + [0.0] * (dim - 1), 1),
             (1204, [1.0, None] + [0.0] * (dim - 2), 1), (1205, [], 1), (1206, [1.0, 2.0], 1), (1207, [1.0, 2.0], 1), (None, rows[9][1], rows[9][2])]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, "s", 1) for i, v, y in rows], SCHEMA).repartition(4)


def good(v) -> bool:
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b) -> float:
    a, b = np.array(a, dtype=np.float64), np.array(b, dtype=np.float64)
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def brute_links(rows, threshold):
    up, n = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            (_, x, p), (_, y, q) = rows[a], rows[b]
            if p is not None and p == q and good(x) and good(y) and len(x) == len(y) and cosine(x, y) >= threshold:
                n[a] += 1
                n[b] += 1
                up[max(find(a), find(b))] = min(find(a), find(b))
    ids = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(i, ids.get(find(k), i))
    return Counter((i, n[k], ids.get(find(k))) for k, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize("tile,threshold,tile_bytes", [(4096, 0.93, 16 << 20), (20, 0.93, 16 << 20), (50, 0.8, 16 << 20), (4096, 0.93, 8 * 16 * 70)])
def test_links(spark, monkeypatch, tile, threshold, tile_bytes):
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    monkeypatch.setattr(embed_dedup, "TILE_BYTES", tile_bytes)
    rows = vectors()
    got = Counter(map(tuple, embed_dedup.link_vectors(table(spark, rows), threshold).collect()))
    assert got == brute_links(rows, threshold)


def test_links_of_nothing(spark):
    assert embed_dedup.link_vectors(table(spark, [])).collect() == []
    assert [tuple(r) for r in embed_dedup.link_vectors(table(spark, [(1, None, 1)])).collect()] == [(1, 0, 1)]


def test_calibrated_count_keeps_pairs_at_the_threshold():
    need = embed_dedup.least_count()
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.standard_normal((4000, 64))
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    y = 0.9301 * x + np.sqrt(1 - 0.9301**2) * side
    i, j = embed_dedup.linked(x, y, False, 0.93, need)
    assert set(range(4000)) <= {a for a, b in zip(i, j) if a == b}


@pytest.mark.parametrize("same", [True, False])
def test_windows_count_every_collision(same):
    """Sorted windows give the pairs that a plain count over all pairs and lines gives, block by block."""
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((9, 24))
    x, y = (embed_dedup.unit(centre[rng.integers(0, 9, n)] + rng.choice([0.0, 0.1, 0.3], (n, 1)) * rng.standard_normal((n, 24))) for n in (700, 300))
    y = x if same else y
    lines, half = embed_dedup.directions(24)[:, 1:], embed_dedup.WINDOW * np.sqrt(2 - 2 * 0.93)
    need = embed_dedup.least_count()
    count = sum((np.abs(a[:, None] - b[None, :]) <= half).astype(int) for a, b in zip((x @ lines).T, (y @ lines).T))
    i, j = np.nonzero((count >= need) & (x @ y.T >= 0.93))
    expected = {(a, b) for a, b in zip(i.tolist(), j.tolist()) if not same or a < b}
    blocks = list(embed_dedup.link_blocks(x, y, same, 0.93, need))
    assert len(blocks) > 1 and expected
    pairs = [p for i, j in blocks for p in zip(i.tolist(), j.tolist())]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected


def test_joined_forests_equal_one():
    rng = np.random.default_rng(6)
    i, j = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    root = np.arange(200)
    for at in range(0, 150, 40):
        root = embed_dedup.grown(root, i[at : at + 40], j[at : at + 40])
    assert (root == forest(200, i, j)).all()


def test_tile_of_near_copies_stays_small():
    """Near copies of dimension 768, a tile's worth: all pairs link, and no more than a block of them is held."""
    import tracemalloc

    rng = np.random.default_rng(2)
    n = embed_dedup.TILE_BYTES // (8 * 768)
    x = embed_dedup.unit(rng.standard_normal(768) + 0.02 * rng.standard_normal((n, 768)))
    root, links = np.arange(n), 0
    tracemalloc.start()
    for i, j in embed_dedup.link_blocks(x, x, True, 0.93, embed_dedup.least_count()):
        root, links = embed_dedup.grown(root, i, j), links + len(i)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links == n * (n - 1) // 2 and not root.any() and peak < 250 << 20


def test_forest():
    rng = random.Random(3)
    i = np.array([rng.randrange(100) for _ in range(60)])
    j = np.array([rng.randrange(100) for _ in range(60)])
    root = forest(100, i, j)
    assert (root[i] == root[j]).all() and (root <= np.arange(100)).all() and (root[root] == root).all()
    assert (forest(3, np.array([], dtype=int), np.array([], dtype=int)) == np.arange(3)).all()


SMALL = ann.Settings(branch=4, leaf_rows=8, sample_rows=200, trial_queries=40, block_rows=50, block_queries=7)


def brute_nearest(rows, k):
    out = {}
    usable = [(i, v) for i, v, _ in rows if good(v) and len(v) == 16]
    for a, (i, v) in enumerate(usable):
        if i is not None and i % 10 == 0:
            found = [(-cosine(v, w), j is None, j or 0) for b, (j, w) in enumerate(usable) if a != b]
            out[i] = sorted(found)[:k]
    return out


def test_nearest(spark):
    rows = vectors(seed=5, n=500)
    got = {}
    for r in ann.nearest(table(spark, rows), F.col("vec_id") % 10 == 0, settings=SMALL).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    expected = brute_nearest(rows, 5)
    assert set(got) == set(expected)
    vec = {i: v for i, v, _ in rows if i is not None}
    hit = 0
    for q, found in got.items():
        assert sorted(found) == [1, 2, 3, 4, 5]
        for rank, (i, score) in found.items():
            assert i is None or abs(score - cosine(vec[q], vec[i])) < 1e-12
            hit += score >= -expected[q][4][0] - 1e-12
        keys = [(-round(s, 12), i is None, i or 0) for _, (i, s) in sorted(found.items())]
        assert keys == sorted(keys)
    assert hit >= 0.9 * 5 * len(got)


def test_nearest_with_few_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 1.0], None)]
    first = F.col("vec_id") == 0
    got = [tuple(r) for r in ann.nearest(table(spark, rows), first).orderBy("rank").collect()]
    assert [(q, k, i) for q, k, i, _ in got] == [(0, 1, 2), (0, 2, 1)]
    assert ann.nearest(table(spark, []), first).collect() == []
    assert ann.nearest(table(spark, rows[:1]), first).collect() == []


def recall(spark, rows, asked):
    """(rows per query, share of the five nearest found) at production settings; ties count by score."""
    got = {}
    for r in ann.nearest(table(spark, [(i, v, 0) for i, v in rows]), asked).collect():
        got.setdefault(r.query_id, []).append(r.score)
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    hit = 0
    for q, scores in got.items():
        at = int(np.flatnonzero(ids == q)[0])
        near = np.delete(x @ x[at], at)
        fifth = np.sort(near)[-5]
        hit += sum(s >= fifth - 1e-9 for s in scores)
    return {len(s) for s in got.values()}, hit / (5 * len(got)), len(got)


def test_single_vectors_beside_large_groups(spark):
    """Groups of copies fill most leaves; single vectors among them get all their rows."""
    rng = np.random.default_rng(9)
    groups = rng.standard_normal((120, 16))
    rows = [(1000 + k, groups[k % 120].tolist()) for k in range(12_000)] + [(k, rng.standard_normal(16).tolist()) for k in range(60)]
    sizes, share, asked = recall(spark, rows, F.col("vec_id") < 60)
    assert sizes == {5} and asked == 60 and share >= 0.9
    sizes, share, asked = recall(spark, rows, F.col("vec_id") % 50 == 0)
    assert sizes == {5} and asked == 242 and share >= 0.9


def test_recall_over_the_whole_table(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pydict()
    sizes, share, asked = recall(spark, list(zip(t["vec_id"], t["embedding"])), F.col("vec_id") % 50 == 0)
    assert sizes == {5} and asked == 40 and share >= 0.9
