"""Operator 2: near-duplicate documents by MinHash, banding, verification and components.

A document is the set of its distinct word shingles.  Documents with equal sets are one
node from the start.  Nodes are linked when their sets have a Jaccard similarity of at
least ``percent`` / 100; groups are the connected components of the links.

Steps, each over all rows:

1. One pass sketches whole texts: ``BANDS`` x ``ROWS`` universal hash minima (16 bits of
   each are kept) and a 128-bit digest of the set.  The input and the sketches are written.
2. Nodes: one row per digest, named by its first row.  Every band of a signature is a bucket key; buckets are
   counted by a partial aggregate and those with one node go.
3. Stars: each node of a bucket is compared with the bucket's smallest node only, so a
   bucket of any size gives one pair per node.  Pairs whose signatures agree on too few
   places go; the others are verified on their full sets, in blocks per centre.
4. Components of the links.
5. What stars cannot see: in a bucket whose nodes are in different components, nodes
   outside its largest component meet the others block by block on their signatures.  At
   first each is verified with the few that agree most, and components are joined up: in
   a large group of copies that are not all similar to each other, this leaves one.
6. The same again with every pair that agrees; in large buckets these are verified on full
   sets where they meet, so they never become rows.  No link between texts that share a
   bucket is lost; a bucket within one component (the usual case) costs nothing.
7. Components again, and one row per document.

A pair at exactly 0.75 shares no bucket with probability (1 - 0.75^4)^32 = 5e-6, and a
linked pair agrees on fewer places than step 3 asks with probability 1e-7.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Scratch, slices
from .components import components, forest

ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
#: Least share of agreeing minima (expected: the similarity, with deviation 0.04).
AGREE = 0.55
#: Nodes verified against one centre, or compared with each other, in one group.
BLOCK = 64
RESIDUE_BLOCK = 512
#: Buckets of more nodes are verified in place, smaller ones pair by pair.
LARGE = 64
#: Partners that an outside node is first verified with, per bucket and block.
BEST = 3
#: Row numbers broadcast to pick out texts (8 bytes each); beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles, from 64-bit hashes of words.

    Words are split at ASCII white space after lower-casing A-Z.  A text with fewer
    than ``width`` words has one shingle, its whole sequence; without words, none.
    """
    words = text.encode().translate(_FOLD).split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=n)
    width = min(width, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out *= _BASE
        out += h[k : n - width + 1 + k]
        out ^= out >> np.uint64(31)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return np.unique(out)


def hash_family(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift universal hashes: odd factors and offsets."""
    draw = np.random.default_rng(seed).integers(0, 1 << 64, size=(2, count, 1), dtype=np.uint64)
    return draw[0] | np.uint64(1), draw[1]


def signature(found: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """16 bits of every hash's minimum over ``found`` (not empty)."""
    a, b = family
    least = np.full(a.shape[0], np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 512):
        least = np.minimum(least, (a * found[at : at + 512] + b).min(axis=1))
    # The minimum's upper half is small by nature: mix before cutting it down.
    return ((least ^ (least >> np.uint64(29))) * _MIX >> np.uint64(48)).astype("<u2")


def sketch(texts: DataFrame, width: int) -> DataFrame:
    """(rid, doc_id, text) to rid, doc_id, n (set size), digest and signature (null for
    empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(HASHES)
        for batch in slices(batches):
            n, digest, sig = [], [], []
            for text in batch.column(2).to_pylist():
                found = shingles(text, width)
                n.append(len(found))
                digest.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sig.append(signature(found, family).tobytes() if len(found) else None)
            new = [pa.array(n, type=pa.int64()), pa.array(digest, type=pa.binary()), pa.array(sig, type=pa.binary())]
            yield pa.record_batch([batch.column(0), batch.column(1), *new], names=["rid", "doc_id", "n", "digest", "sig"])

    return texts.mapInArrow(run, "rid long, doc_id long, n long, digest binary, sig binary")


def _agreeing(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, sig_a, sig_b) whose signatures agree on enough places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype="<u2").reshape(-1, HASHES) for k in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((a == b).mean(axis=1) >= AGREE))

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough, as links (u, v).

    The pairs of one ``b`` are dealt into blocks of about ``BLOCK``; a block holds the
    text of ``b`` once.  ``pairs`` is a written table, ``texts`` is (rid, text).
    """
    size = pairs.groupBy("b").agg(F.count("*").alias("n"))
    dealt = pairs.join(size, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / BLOCK)).alias("block"))
    wanted = dealt.select(F.col("a").alias("rid"), "b", "block").unionByName(
        dealt.select(F.col("b").alias("rid"), "b", "block").distinct()
    )
    few = 2 * pairs.count() <= BROADCAST_ROWS  # at most two rows per pair
    found = texts.join(F.broadcast(wanted) if few else wanted, "rid").select("b", "block", "rid", "text")

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        centre = key[0]
        sets = {n: shingles(t, width) for n, t in zip(pdf["rid"], pdf["text"])}
        own, linked = sets[centre], []
        for n, other in sets.items():
            if n != centre:
                common = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * common >= percent * (len(own) + len(other) - common):
                    linked.append(n)
        return pd.DataFrame({"u": np.array(linked, dtype=np.int64), "v": np.full(len(linked), centre, dtype=np.int64)})

    return scratch.write(found.groupBy("b", "block").applyInPandas(compare, "u long, v long"), "links")


def _mixed(multi: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, band, node, component, major, most, all): buckets with nodes of several components."""
    placed = multi.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = (
        counts.groupBy("key")
        .agg(F.max_by("component", F.struct("n", "component")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("all"))
        .filter("most < all")
    )
    return scratch.write(placed.join(mixed, "key"), "mixed")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of mixed buckets as units (key, i, j): blocks of nodes outside the largest
    component (lhs) with blocks of all nodes."""
    deal = lambda n: F.ceil(n / RESIDUE_BLOCK)
    minor, whole = deal(F.col("all") - F.col("most")), deal(F.col("all"))
    own = lambda n: F.pmod(F.xxhash64("node"), n)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    columns = [F.col(c) for c in rows.columns if c not in ("major", "most", "all")]
    left = rows.filter("component <> major").select(own(minor).alias("i"), each(whole).alias("j"), F.lit(True).alias("lhs"), *columns)
    right = rows.select(own(whole).alias("j"), each(minor).alias("i"), F.lit(False).alias("lhs"), *columns)
    return left.unionByName(right)


def _agreeing_pairs(mixed: DataFrame, nodes: DataFrame, percent: int, best: int | None = None) -> DataFrame:
    """Pairs (a, b) across components within a bucket whose signatures agree, once each.

    With ``best``, only as many pairs of each outside node and unit, those that agree most.
    """

    def pairs(rows: dict[str, np.ndarray], stops: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs of the units that end at ``stops``."""
        x, y, held = [], [], 0
        for lo, hi in zip([0, *stops[:-1].tolist()], stops.tolist()):
            lhs = rows["lhs"][lo:hi]
            left, right = lo + np.flatnonzero(lhs), lo + np.flatnonzero(~lhs)
            x.append(np.repeat(left, len(right)))
            y.append(np.tile(right, len(left)))
            held += len(x[-1])
            if held >= 1 << 16 or hi == stops[-1]:
                yield near(rows, np.concatenate(x), np.concatenate(y))
                x, y, held = [], [], 0

    def near(rows: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        n, sig = rows["n"], rows["sig"]
        # Sets of too different sizes cannot be similar.
        ok = (rows["component"][x] != rows["component"][y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
        x, y = x[ok], y[ok]
        agree = np.concatenate([(sig[x[k : k + 8192]] == sig[y[k : k + 8192]]).sum(axis=1) for k in range(0, max(1, len(x)), 8192)])
        ok = agree >= AGREE * HASHES
        x, y, agree = x[ok], y[ok], agree[ok]
        if best is not None and len(x):
            order = np.lexsort((-agree, x))
            x, y = x[order], y[order]
            first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            rank = np.arange(len(x)) - np.repeat(first, np.diff(np.r_[first, len(x)]))
            x, y = x[rank < best], y[rank < best]
        a, b = rows["node"][x], rows["node"][y]
        return pa.record_batch([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Units arrive one after the other; the last of a batch may go on in the next."""
        rest: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            rest += [batch] if batch is not None and batch.num_rows else []
            if not rest:
                continue
            table = pa.Table.from_batches(rest)
            rows = {c: table[c].to_numpy() for c in ("key", "i", "j", "lhs", "node", "component", "n")}
            change = np.flatnonzero(np.any([rows[c][1:] != rows[c][:-1] for c in ("key", "i", "j")], axis=0)) + 1
            stops = np.r_[change, table.num_rows] if batch is None else change
            if len(stops):
                rows["sig"] = np.frombuffer(b"".join(table["sig"].to_pylist()), dtype="<u2").reshape(-1, HASHES)
                yield from pairs(rows, stops)
                rest = table.slice(int(stops[-1])).combine_chunks().to_batches()

    rows = mixed.drop("band").join(nodes.select("node", "sig", "n"), "node")
    units = _dealt(rows).select("key", "i", "j", "lhs", "node", "component", "n", "sig")
    sorted_units = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return sorted_units.mapInArrow(run, "a long, b long").distinct()


def _links_in_place(mixed: DataFrame, texts: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) across components within large buckets, verified on the full sets.

    Texts travel with the buckets' blocks and pairs never become rows.  A pair is looked
    at in the first bucket it shares; a unit returns a spanning forest of its links.
    """
    placed = mixed.join(nodes.select("node", "sig", "n"), "node")
    few = mixed.count() <= BROADCAST_ROWS // 16  # signatures travel along
    rows = texts.withColumnRenamed("rid", "node").join(F.broadcast(placed) if few else placed, "node")

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"u": np.zeros(0, dtype=np.int64), "v": np.zeros(0, dtype=np.int64)})
        x, y = pdf[pdf["lhs"]].reset_index(drop=True), pdf[~pdf["lhs"]].reset_index(drop=True)
        if not len(x) or not len(y):
            return none
        sx, sy = (np.frombuffer(b"".join(p["sig"]), dtype="<u2").reshape(-1, HASHES).T.copy() for p in (x, y))
        nx, ny = x["n"].to_numpy()[:, None], y["n"].to_numpy()
        ok = x["component"].to_numpy()[:, None] != y["component"].to_numpy()
        ok &= 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)
        agree, before = np.zeros(ok.shape, dtype=np.uint8), np.zeros(ok.shape, dtype=bool)
        for band in range(BANDS):
            whole = np.ones(ok.shape, dtype=bool)
            for p in range(band * ROWS, (band + 1) * ROWS):
                same = sx[p][:, None] == sy[p]
                agree += same
                whole &= same
            if band < x["band"][0]:
                before |= whole
        ok &= ~before & (agree >= AGREE * HASHES)
        used_x, used_y = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
        if not len(used_x):
            return none
        sets = [shingles(t, width) for t in [*x["text"][used_x], *y["text"][used_y]]]
        # Shingles of both sides as columns; a product counts the common ones.
        names, at = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), [len(f) for f in sets])
        left = row < len(used_x)
        both = np.intersect1d(at[left], at[~left])
        column = np.full(len(names), -1)
        column[both] = np.arange(len(both))
        common = np.zeros((len(used_x), len(used_y)), dtype=np.float32)
        for lo in range(0, len(both), 8192):
            cells = np.zeros((len(sets), min(8192, len(both) - lo)), dtype=np.float32)
            c = column[at]
            inside = (c >= lo) & (c < lo + cells.shape[1])
            cells[row[inside], c[inside] - lo] = 1
            common += cells[: len(used_x)] @ cells[len(used_x) :].T
        union = nx[used_x] + ny[used_y] - common
        i, j = np.nonzero(ok[np.ix_(used_x, used_y)] & (100 * common >= percent * union))
        ids = np.concatenate([x["node"].to_numpy()[used_x], y["node"].to_numpy()[used_y]])
        root = forest(len(ids), i, j + len(used_x))
        moved = np.flatnonzero(root != np.arange(len(ids)))
        return pd.DataFrame({"u": ids[moved], "v": ids[root[moved]]})

    return _dealt(rows).groupBy("key", "i", "j").applyInPandas(compare, "u long, v long")


def _input(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` as a written table of (rid, row), so that row numbers stay."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return scratch.write(docs.select(F.monotonically_increasing_id().alias("rid"), row.alias("row")), "input")


def _groups(base: DataFrame, text: str, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """(rid, doc_id, n_shingles, component_id, keep_rid) of every row of ``base``."""
    doc_id = F.col("row.doc_id").cast("long").alias("doc_id")
    texts = base.select("rid", doc_id, F.col(f"row.`{text}`").cast("string").alias("text"))
    sketched = scratch.write(sketch(texts, width), "sketch")
    texts = texts.drop("doc_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")

    filled = sketched.filter("n > 0").withColumn("first", order)
    sets = filled.groupBy("digest").agg(F.min("first").alias("first"), F.min("sig").alias("sig"), F.min("n").alias("n"))
    nodes = scratch.write(sets.select(F.col("first.rid").alias("node"), "digest", "first", "sig", "n"), "nodes")

    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * 2 * ROWS + 1, F.lit(2 * ROWS))))
    banded = nodes.select("node", F.posexplode(band).alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1")
    multi = scratch.write(banded.join(buckets, "key"), "buckets")

    side = lambda k: nodes.select(F.col("node").alias(k), F.col("sig").alias(f"sig_{k}"))
    agreeing = lambda pairs: _agreeing(pairs.join(side("a"), "a").join(side("b"), "b"))
    verify = lambda pairs: _verify(scratch.write(pairs, "pairs"), texts, width, percent, scratch)

    stars = multi.filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    labels = components(verify(agreeing(stars)), scratch)
    multi = multi.select("key", "band", "node", F.col("n").alias("size"))
    for best in (BEST, None):
        mixed = _mixed(multi, labels, scratch)
        if mixed.isEmpty():
            break
        small = mixed if best else mixed.filter(F.col("size") <= LARGE)
        more = verify(_agreeing_pairs(small.drop("size"), nodes, percent, best))
        if not best:
            large = mixed.filter(F.col("size") > LARGE).drop("size")
            more = more.unionByName(scratch.write(_links_in_place(large, texts, nodes, width, percent), "links"))
        if not more.isEmpty():  # what is known already is a star per component
            known = labels.select(F.col("node").alias("u"), F.col("component").alias("v"))
            labels = components(known.unionByName(more), scratch)

    grouped = nodes.join(labels, "node", "left").select("digest", "first", F.coalesce("component", "node").alias("component"))
    smallest = grouped.groupBy("component").agg(F.min("first").alias("keep"))
    chosen = grouped.join(smallest, "component").select("digest", "keep")
    keep = F.coalesce("keep", "first")
    return (
        sketched.select("rid", "doc_id", F.col("n").alias("n_shingles"), "digest")
        .join(chosen, "digest", "left")
        .withColumn("first", order)
        .select("rid", "doc_id", "n_shingles", keep["doc_id"].alias("component_id"), keep["rid"].alias("keep_rid"))
    )


def group_documents(docs: DataFrame, text: str = "text", width: int = 5, percent: int = 75, scratch: Scratch | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, rid, keep_rid.

    component_id is the smallest doc_id of the row's group, rid numbers the rows and
    keep_rid is the row that stays (the first of that id).  Texts without words (null,
    empty, white space) are alone in their group.  Null ids take part: they are after all
    others, so a group without any id has a null component_id.  Repeated rows are copies
    of each other.  Other columns of ``docs`` are ignored, whatever their names; an empty
    table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession, "minhash")
    base = _input(docs.select("doc_id", F.col(f"`{text}`")), scratch)
    return _groups(base, text, width, percent, scratch).select("doc_id", "n_shingles", "component_id", "rid", "keep_rid")


def drop_near_duplicates(docs: DataFrame, text: str = "text", width: int = 5, percent: int = 75, scratch: Scratch | None = None) -> DataFrame:
    """One row of each group of near duplicates, with the columns of ``docs``.

    The row numbers that go are taken out of the written input; up to ``BROADCAST_ROWS``
    of them are broadcast, so that texts are not shuffled.
    """
    scratch = scratch or Scratch(docs.sparkSession, "minhash")
    base = _input(docs, scratch)
    gone = scratch.write(_groups(base, text, width, percent, scratch).filter("rid <> keep_rid").select("rid"), "gone")
    few = gone.count() <= BROADCAST_ROWS
    return base.join(F.broadcast(gone) if few else gone, "rid", "left_anti").select("row.*")
