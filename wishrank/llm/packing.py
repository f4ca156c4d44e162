"""Operator 1: pack documents into sequences of a fixed length with little padding.

Shortest-pack-first over the length histogram (Krell et al., 2021): lengths are
placed longest first, each into the open packs with the most room, on *counts* of
packing patterns instead of single documents.  The histogram has at most
``max_len`` rows whatever the input, so only it and the patterns it gives are
handled in the driver.  The patterns become rank intervals per length, and each
piece finds its sequence by its rank among the pieces of its length.

Steps, each over all rows:

1. One pass tokenizes every text and cuts it into pieces of ``max_len`` tokens and
   a rest; the pieces (not the texts) are written as a stage.
2. A partial aggregate counts the pieces per length.
3. Ranks: pieces are dealt into salt buckets of bounded size, numbered within
   (length, bucket), and shifted by the counts of the buckets before, so a length
   that a third of all pieces share is never numbered in one task.
4. Every piece looks up the interval of its (length, rank) by binary search.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .common import Scratch, slices

#: Pieces numbered together in one window group, on average.
BUCKET_ROWS = 50_000

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def fill_patterns(histogram: dict[int, int], max_len: int) -> list[tuple[list[int], int]]:
    """Packing patterns ``(lengths, count)`` that use up ``histogram`` exactly.

    Lengths are placed longest first into the group of open packs with the most
    room left; a group takes one more piece in each of its packs, or is split when
    fewer pieces are left.  Only when nothing has room are new packs opened, each
    filled with as many pieces of that length as fit.  Groups stay few: each length
    adds at most two and splits at most one.
    """
    done: list[tuple[list[int], int]] = []
    open_packs: list[tuple[int, int, list[int], int]] = []  # (-room, tie, lengths, count)
    tie = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= max_len:
            raise ValueError(f"length {length} outside 1..{max_len}")
        while left:
            if open_packs and -open_packs[0][0] >= length:
                room, _, lengths, count = heapq.heappop(open_packs)
                take = min(left, count)
                if take < count:
                    tie += 1
                    heapq.heappush(open_packs, (room, tie, lengths, count - take))
                new, n = lengths + [length], take
                left -= take
                room = -room - length
            else:
                each = max_len // length
                n = left // each
                if n == 0:
                    each, n = left, 1
                new = [length] * each
                left -= each * n
                room = max_len - each * length
            if room:
                tie += 1
                heapq.heappush(open_packs, (-room, tie, new, n))
            else:
                done.append((new, n))
    return done + [(lengths, count) for _, _, lengths, count in sorted(open_packs, key=lambda p: (p[0], p[1]))]


def rank_intervals(patterns: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first ranks (sorted), sequence id of that rank, offset in the sequence."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, count in patterns:
        at = 0
        for length in lengths:
            first = used.get(length, 0)
            rows.setdefault(length, []).append((first, sequence, at))
            used[length] = first + count
            at += length
        sequence += count
    return {k: tuple(np.array(v, dtype=np.int64).T) for k, v in rows.items()}


def tokenize_pieces(
    docs: DataFrame, rank_file: str, max_len: int = 2048, end_id: int = 1, keep_ids: bool = False
) -> DataFrame:
    """One row per piece of every document's ids (its end id included).

    Null text counts as empty, so every document has at least its end id.
    ``keep_ids`` adds the ids of each piece.
    """
    schema = PIECE_SCHEMA + (", ids array<int>" if keep_ids else "")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    types = [pa.int64()] * 5 + [pa.list_(pa.int32())] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.load(rank_file)
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = bpe.encode(enc, text or "")
                ids.append(end_id)
                raw, n = memoryview(np.asarray(ids, dtype="<u4").tobytes()), len(ids)
                for at in range(0, n, max_len):
                    end = min(n, at + max_len)
                    row = (doc_id, at, end - at, zlib.crc32(raw[4 * at : 4 * end]), n)
                    rows.append((*row, ids[at:end].tolist()) if keep_ids else row)
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def assign_sequences(pieces: DataFrame, max_len: int = 2048, scratch: Scratch | None = None) -> DataFrame:
    """``pieces`` (any rows with a ``length`` of 1 to ``max_len``) with ``sequence_id`` and ``offset``."""
    scratch = scratch or Scratch(pieces.sparkSession, "packing")
    own = pieces.columns
    rows = scratch.write(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    intervals = rank_intervals(fill_patterns(histogram, max_len))

    buckets = 1 + sum(histogram.values()) // BUCKET_ROWS
    salted = rows.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        salted.groupBy("length", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    number = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_row")) - 1
    ranked = (
        salted.withColumn("_number", number)
        .join(shift, ["length", "_bucket"])
        .select(*own, (F.col("_shift") + F.col("_number")).alias("_rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            ranks = batch.column(batch.num_columns - 1).to_numpy()
            sequence = np.zeros(len(ranks), dtype=np.int64)
            offset = np.zeros(len(ranks), dtype=np.int64)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                first, base, shift = intervals[length]
                k = np.searchsorted(first, ranks[at], side="right") - 1
                sequence[at] = base[k] + ranks[at] - first[k]
                offset[at] = shift[k]
            columns = [*batch.columns[:-1], pa.array(sequence), pa.array(offset)]
            yield pa.record_batch(columns, names=[*own, "sequence_id", "offset"])

    schema = T.StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, rank_file: str, max_len: int = 2048, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """Sequences of at most ``max_len`` tokens holding every id of ``docs`` once.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens
    (, ids), sequence_id, offset.  Null or empty texts give one piece with the end
    id alone; rows with equal or null doc_id are packed each on their own; an empty
    table gives no rows; other columns of ``docs`` are ignored, whatever their names.
    """
    pieces = tokenize_pieces(docs, rank_file, max_len, end_id, keep_ids)
    return assign_sequences(pieces, max_len, Scratch(docs.sparkSession, "packing"))
