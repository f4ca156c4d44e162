"""Operator 10: toxicity by FTRL-proximal logistic regression over hashed n-grams.

A document is the set of its hashed words, word stems (their first bytes, so that
inflected forms share a coordinate), word pairs and skip-grams (pairs with one word
between).  The model is fitted by FTRL-proximal: per-coordinate learning rates
and an L1 term that leaves most coordinates exactly zero, so the weights are a short
list that is broadcast whatever the corpus.

* Fitting takes at most ``max_rows`` labelled rows (a documented bound, drawn evenly by
  a hash of the id); their ids are broadcast, so no text is shuffled.
* The sample is dealt into shards that are fitted side by side; after each round their
  states are averaged per coordinate over the shards that touched it (parameter mixing).
* Scoring reads every whole text once, in batches, without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, slices

# ASCII punctuation and control bytes to spaces; bytes of longer characters stay.
_SPLIT = bytes(b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PAIR = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))

#: Bytes of a word that its stem keeps.
STEM = 4


@dataclass(frozen=True)
class Settings:
    bits: int = 20  # 2^bits coordinates
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.0
    rounds: int = 6
    max_rows: int = 40_000  # labelled rows that the model is fitted on, at most
    shard_rows: int = 5_000


@dataclass(frozen=True)
class Weights:
    """The nonzero coordinates of a fitted model."""

    index: np.ndarray
    value: np.ndarray
    bias: float
    bits: int



def coordinates(text: str | None, bits: int) -> np.ndarray:
    """Hashed words, stems, pairs and skip-grams of a whole text, with repeats."""
    words = text.lower().encode().translate(_SPLIT).split() if text else []
    h = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    stem = np.fromiter((zlib.crc32(w[:STEM]) for w in words), dtype=np.uint64, count=len(words))
    shift = np.uint64(64 - bits)
    grams = [h * _MIX, stem * _PAIR[1], (h[:-1] * _PAIR[0]) ^ (h[1:] * _PAIR[1]), (h[:-2] * _PAIR[2]) ^ (h[2:] * _PAIR[0])]
    return (np.concatenate([(g * _MIX) >> shift for g in grams])).astype(np.int64)


def fit_shard(rows: list[np.ndarray], labels: np.ndarray, z: np.ndarray, n: np.ndarray, s: Settings) -> None:
    """One pass of FTRL-proximal over ``rows`` (sets of coordinates); updates z and n.

    The last coordinate is the bias, which L1 leaves alone.
    """
    bias = len(z) - 1
    for at, y in zip(rows, labels):
        at = np.append(at, bias)
        zi, ni = z[at], n[at]
        w = np.where(np.abs(zi) > s.l1, -(zi - np.sign(zi) * s.l1), 0.0)
        w[-1] = -zi[-1]
        w /= (s.beta + np.sqrt(ni)) / s.alpha + s.l2
        g = 1.0 / (1.0 + np.exp(-min(30.0, max(-30.0, w.sum())))) - y
        z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / s.alpha * w
        n[at] = ni + g * g


def finish(z: np.ndarray, n: np.ndarray, s: Settings) -> Weights:
    rate = (s.beta + np.sqrt(n)) / s.alpha + s.l2
    w = np.where(np.abs(z) > s.l1, -(z - np.sign(z) * s.l1) / rate, 0.0)
    index = np.flatnonzero(w[:-1])
    return Weights(index.astype(np.int64), w[index].astype(np.float32), float(-z[-1] / rate[-1]), s.bits)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from (null ids count as learnable; they have no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_labels(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` learnable labelled rows, drawn evenly by a hash of the id."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    total = rows.count()
    if total > max_rows:
        draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(total)) < int(1.05 * max_rows)
        rows = rows.filter(draw).orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id", "y").limit(max_rows)
    return rows


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings(), scratch: Scratch | None = None) -> Weights:
    """A model of ``label`` (0 or 1; other values and null ids are left out).

    Without a usable label the model has no weights and scores everything 0.5.
    """
    s = settings
    scratch = scratch or Scratch(docs.sparkSession, "toxicity")
    drawn = scratch.write(sample_labels(labels, label, s.max_rows), "sample")  # at most max_rows ids
    total = drawn.count()
    if not total:
        return Weights(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), 0.0, s.bits)
    shards = -(-total // s.shard_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.join(F.broadcast(drawn), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [np.unique(coordinates(t, s.bits)).astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(sets, type=pa.list_(pa.int32()))], names=["doc_id", "y", "at"])

    shard = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(shards)).cast("int").alias("shard")
    # Dealt out once and kept for all rounds (max_rows rows at most); what an executor
    # held is computed again from the documents when it is lost.
    rows = known.mapInArrow(features, "doc_id long, y int, at array<int>").select(shard, "doc_id", "y", "at")
    rows = rows.repartition(shards, "shard").persist(StorageLevel.MEMORY_AND_DISK)

    z, n = np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)
    for _ in range(s.rounds):
        on = np.flatnonzero(n)
        state = docs.sparkSession.sparkContext.broadcast((on, z[on], n[on]))

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            at, z0, n0 = state.value
            z, n = np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)
            z[at], n[at] = z0, n0
            pdf = pdf.sort_values("doc_id", key=lambda c: (c * 2654435761) % 4294967291)
            fit_shard(pdf["at"].tolist(), pdf["y"].to_numpy(), z, n, s)
            before_z, before_n = np.zeros(len(z)), np.zeros(len(n))
            before_z[at], before_n[at] = z0, n0
            # Coordinates that hardly moved in this shard are noise;
            # their weight would still be zero, and they are not sent.
            moved = np.flatnonzero((n != before_n) & ((np.abs(z) > 0.2 * s.l1) | (before_n > 0)))
            return pd.DataFrame({"at": [moved.astype(np.int64)], "z": [(z - before_z)[moved]], "n": [(n - before_n)[moved]]})

        sum_z, sum_n, times = np.zeros(len(z)), np.zeros(len(n)), np.zeros(len(n))
        # max_rows / shard_rows rows of at most 2^bits coordinates each.
        for r in rows.groupBy("shard").applyInPandas(one, "at array<long>, z array<double>, n array<double>").collect():
            at = np.asarray(r["at"], dtype=np.int64)
            sum_z[at] += r["z"]
            sum_n[at] += r["n"]
            times[at] += 1
        z += sum_z / np.maximum(times, 1)
        n += sum_n / np.maximum(times, 1)
    rows.unpersist()
    return finish(z, n, s)


def score(docs: DataFrame, weights: Weights, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """Rows of ``docs`` (struct column ``row``) with score (0 to 1) and predicted (score >= threshold).

    Only the text is scored.  Null and empty texts score as the model's bias does; every
    row gives a row.  The columns of ``docs`` stay inside ``row``, so no name can clash.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # Plain arrays: workers need not know this package.
    shared = docs.sparkSession.sparkContext.broadcast((weights.index, weights.value, weights.bias, weights.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, value, bias, bits = shared.value
        table = np.zeros(1 << bits, dtype=np.float32)
        table[index] = value
        for batch in slices(batches):
            sums = np.empty(batch.num_rows)
            for k, body in enumerate(pa.compute.struct_field(batch.column(0), text).to_pylist()):
                at = coordinates(body, bits)
                sums[k] = table[np.unique(at[table[at] != 0])].sum(dtype=np.float64)
            p = 1.0 / (1.0 + np.exp(-np.clip(sums + bias, -30, 30)))
            yield pa.record_batch([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["row", "score", "predicted"])

    schema = T.StructType([*rows.schema.fields]).add("score", "double").add("predicted", T.IntegerType())
    return rows.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (score >= 0.3)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    doc_id = F.col("row.doc_id")
    return score(own, fit(docs, labels, settings=settings)).select(
        doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "score", "predicted"
    )


def clean_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the rows that the model rejects (score >= 0.3)."""
    return score(docs, fit(docs, labels, settings=settings)).filter("predicted = 0").select("row.*")
