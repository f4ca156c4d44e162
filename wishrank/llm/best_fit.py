"""Operator 13: best-fit packing of documents by bulk-synchronous rounds.

The aim is as few sequences as possible.  Sequential best-fit decreasing puts the longest
document left into the smallest gap that holds it.  Here a round does that for a whole class
of lengths at once, and no state but two histograms of at most ``max_len`` lengths and one
line per range partition ever reaches the driver:

1. Documents longer than ``max_len`` are cut; pieces are written once.  The longest pieces
   left are a round's class.  Those that no gap holds open new sequences, as many as their
   tokens need.
2. Pieces of the class and gaps are range-sorted together, largest first, gaps ahead of
   pieces of their size; a gap much larger than every piece left is offered as several slots.
3. Successor sweep: along a range partition, each piece takes the last slot before it that
   is free, which is the smallest that holds it.  What a partition cannot match within
   itself is left as a run of pieces followed by a stack of slots.
4. The runs and stacks of all partitions are matched by their *counts* (one line per
   partition), which gives every remaining piece the rank of its slot: the sweep over all
   rows, as if one task had made it.  Pieces and slots then meet in a join on that rank.
5. Gaps shrink by what they took, and the next round follows.  Pieces left over (all their
   slots went to longer ones) come again.

Equal lengths are told apart by a hash, so a length that a third of all pieces share is
spread over range partitions like any other.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices

#: A cache of word ids in a task is emptied beyond so many bytes of words and ids.
CACHE_BYTES = 16 << 20
#: Longer words are encoded on their own and not kept.
CACHE_WORD = 64
#: Texts are encoded in stretches of so many characters, cut at a space.
STRETCH = 1 << 20

#: Fixed values of the vocabulary file: how it cuts words, and its special strings.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+"""
SPECIAL = "<|"
#: Characters on which Python and that library agree about classes, case and composition.
PLAIN = r"[\t\n\r -~À-ÖØ-öø-įı-ňŊ-ž–-„†-…А-яЁёぁ-ゖァ-ヺ一-鿿가-힣]*"
#: Marks the end of a word; lower-cased text holds none.
END = "A"

GAP, PIECE, MATCH = 0, 1, 2
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def class_floor(longest: int, max_len: int) -> int:
    """Pieces longer than this are a round's class: narrow for long pieces, whose fit
    matters, wide for short ones, and everything from a sixteenth of a sequence down."""
    return int(longest * 0.7) if longest > max_len // 4 else longest // 2 if longest > max_len // 16 else 0


class WordEncoder:
    """Ids of a byte-pair tokenizer with word ends that lower-cases and drops white space.

    Texts of plain characters are cut into words here, each closed by an end mark, and merged
    by a faster library, whose ranks are the tokenizer's merges in their order with the mark
    for its word end.  Merging by rank gives the same ids as long as every token of the
    vocabulary comes out of its own merges, which ``tests/llm`` checks.  Words with other
    characters or special strings go through the tokenizer itself.
    """

    def __init__(self, tokenizer_file: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        self.whole = Tokenizer.from_file(tokenizer_file)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(tokenizer_file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.ranks = end_marked(model["vocab"], model["end_of_word_suffix"])
        self.fast = tiktoken.Encoding("words", pat_str=f"[^{END}]+{END}", mergeable_ranks=self.ranks, special_tokens={})
        self.cut, self.plain = re.compile(WORDS).findall, re.compile(PLAIN).fullmatch
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _plain(self, text: str) -> bytes:
        words = self.cut(text.lower())
        words.append("")
        return self.fast.encode_to_numpy(END.join(words), disallowed_special=()).astype("<u4").tobytes()

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = np.asarray(self.whole.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
            if len(word) <= CACHE_WORD:
                if self.held > CACHE_BYTES:
                    self.known, self.held = {}, 0
                self.known[word] = ids
                self.held += 200 + len(word) + len(ids)
        return ids

    def _stretch(self, text: str) -> bytes:
        if self.plain(text) and SPECIAL not in text:
            return self._plain(text)
        out = []
        for plain, words in groupby(text.replace("\n", " ").split(" "), lambda w: bool(self.plain(w)) and SPECIAL not in w):
            out += [self._plain(" ".join(words))] if plain else map(self._word, words)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if len(text) <= STRETCH:
            return self._stretch(text)
        out, at = [], 0
        while at < len(text):
            end = text.find(" ", at + STRETCH)
            end = len(text) if end < 0 else end
            out.append(self._stretch(text[at:end]))
            at = end
        return b"".join(out)


def end_marked(vocabulary: dict[str, int], suffix: str) -> dict[bytes, int]:
    """Ids of a byte-level vocabulary by bytes, with END for the word-end suffix.

    Byte-level vocabularies write a byte as its character where that is printable Latin-1,
    and the others, in their order, as the characters from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in set(own)]
    byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}

    def raw(token: str) -> bytes:
        ended = token.endswith(suffix)
        return bytes(byte[c] for c in (token[: -len(suffix)] if ended else token)) + END.encode() * ended

    return {raw(token): i for token, i in vocabulary.items()}


def cut_pieces(docs: DataFrame, tokenizer_file: str, max_len: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: whole documents (ids and ``end_id``), or ``max_len`` tokens of longer ones."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordEncoder(tokenizer_file), np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, 128):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = words.encode(text or "") + end
                step = 4 * max_len
                rows += [
                    (doc_id, k, at // 4, len(part := raw[at : at + step]) // 4, zlib.crc32(part))
                    for k, at in enumerate(range(0, len(raw), step))
                ]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECE_SCHEMA)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, id, slot, size), largest first: every piece takes the last free slot.

    Gives matches, and numbered by ``seq`` within the partition, pieces without a slot and
    slots without a piece (the last number is the top of the stack).
    """
    part = TaskContext.get().partitionId()
    names = ["part", "kind", "seq", "piece", "size", "bin", "slot"]
    types = [pa.int32(), pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    stack: list[tuple[int, int, int]] = []
    alone = 0

    def rows(columns: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

    for batch in slices(batches, 65536):
        out = []
        for kind, own, slot, size in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if kind == GAP:
                stack.append((size, own, slot))
            elif stack:
                _, bin_, slot = stack.pop()
                out.append((part, MATCH, 0, own, size, bin_, slot))
            else:
                out.append((part, PIECE, alone, own, size, None, None))
                alone += 1
        if out:
            yield rows(list(zip(*out)))
    for at in range(0, len(stack), 65536):
        some = stack[at : at + 65536]
        yield rows(list(zip(*((part, GAP, at + k, None, size, bin_, slot) for k, (size, bin_, slot) in enumerate(some)))))


def match_counts(left: dict[int, tuple[int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Stacks of slots and runs of pieces of all partitions, matched by their counts.

    ``left``: per partition (pieces without a slot, slots without a piece).  Gives
    (piece partition, first piece, slot partition, end of slots, count, first rank): piece
    ``first + i`` takes slot ``end - 1 - i`` and both get the rank ``first rank + i``.
    """
    out, stack, rank = [], [], 0
    for part in sorted(left):
        need, free = left[part]
        at = 0
        while at < need and stack:
            q, end = stack.pop()
            n = min(need - at, end)
            out.append((part, at, q, end, n, rank))
            at, rank = at + n, rank + n
            if n < end:
                stack.append((q, end - n))
        if free:
            stack.append((part, free))
    return out


def pack(sizes: DataFrame, max_len: int, scratch: Scratch) -> DataFrame:
    """(id, sequence_id, offset) for every row of ``sizes`` (id unique, length 1 to ``max_len``).

    ``sizes`` must be a written stage: it is read in every round.
    """
    spark = sizes.sparkSession
    gaps = spark.createDataFrame([], "bin long, gap long")
    again = spark.createDataFrame([], "id long, length long")
    # Histograms by length: pieces never offered yet, pieces that come again, gaps.
    fresh = Counter({r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.count("*").alias("n")).collect()})
    if fresh and not 0 < min(fresh) <= max(fresh) <= max_len:
        raise ValueError(f"lengths from {min(fresh)} to {max(fresh)}, not within 1..{max_len}")
    shortest, floor = min(fresh, default=0), max_len
    waiting: Counter[int] = Counter()
    room: Counter[int] = Counter()
    bins, placed = 0, []
    while fresh or waiting:
        longest = max([*fresh, *waiting])
        top, floor = floor, min(floor, class_floor(longest, max_len))
        offered = waiting + Counter({k: n for k, n in fresh.items() if k > floor})
        fresh = Counter({k: n for k, n in fresh.items() if k <= floor})
        least = min(offered)
        # Sequences that the class needs beyond the gaps there are.
        most = max(room, default=0)
        homeless = {k: n for k, n in offered.items() if k > most}
        tokens = sum(k * n for k, n in homeless.items())
        new = max(-(-tokens // max_len), sum(n for k, n in homeless.items() if 2 * k > max_len))
        state = gaps
        if new:
            opened = spark.range(bins, bins + new).select(F.col("id").alias("bin"), F.lit(max_len).cast("long").alias("gap"))
            state, bins = gaps.unionByName(opened), bins + new
        # A gap of many times the longest piece is that many slots, so each round fills it.
        slots = F.greatest(F.lit(1), F.floor(F.col("gap") / longest)).cast("int")
        rows = (
            state.filter(F.col("gap") >= least)
            .select("bin", F.floor(F.col("gap") / slots).alias("size"), F.explode(F.sequence(F.lit(1), slots)).alias("slot"))
            .select(F.lit(GAP).alias("kind"), F.col("bin").alias("id"), "slot", "size")
        )
        class_ = sizes.filter((F.col("length") > floor) & (F.col("length") <= top)).select("id", "length").unionByName(again)
        rows = rows.unionByName(class_.select(F.lit(PIECE).alias("kind"), "id", F.lit(0).alias("slot"), F.col("length").alias("size")))
        order = [F.desc("size"), F.asc("kind"), F.xxhash64("id", "slot"), F.asc("id")]
        swept = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            sweep, "part int, kind byte, seq long, piece long, size long, bin long, slot int"
        )
        swept = scratch.write(swept, "swept")
        counts: dict[int, list[int]] = {}
        for r in swept.filter(F.col("kind") != MATCH).groupBy("part", "kind").count().collect():  # two rows per partition
            counts.setdefault(r["part"], [0, 0])[0 if r["kind"] == PIECE else 1] = r["count"]
        lines = match_counts({k: tuple(v) for k, v in counts.items()})

        pairs = swept.filter(F.col("kind") == MATCH).select("piece", "size", "bin", "slot")
        pieces = swept.filter(F.col("kind") == PIECE).select("part", "seq", "piece", "size")
        free = swept.filter(F.col("kind") == GAP).select("part", "seq", "bin", "slot")
        alone = pieces
        if lines:
            ranks = F.broadcast(spark.createDataFrame(lines, "p int, at long, q int, end long, n long, rank long"))  # two lines per partition
            take = (F.col("part") == F.col("p")) & (F.col("seq") >= F.col("at")) & (F.col("seq") < F.col("at") + F.col("n"))
            give = (F.col("part") == F.col("q")) & (F.col("seq") < F.col("end")) & (F.col("seq") >= F.col("end") - F.col("n"))
            ranked = pieces.join(ranks, take, "left").withColumn("rank", F.col("rank") + F.col("seq") - F.col("at"))
            alone = ranked.filter(F.col("rank").isNull())
            slot = free.join(ranks, give).select((F.col("rank") + F.col("end") - 1 - F.col("seq")).alias("rank"), "bin", "slot")
            met = ranked.filter(F.col("rank").isNotNull()).select("rank", "piece", "size").join(slot, "rank")
            pairs = pairs.unionByName(met.select("piece", "size", "bin", "slot"))
        # At most max_len pieces per sequence.
        took = pairs.groupBy("bin").agg(
            F.sum("size").alias("used"), F.sort_array(F.collect_list(F.struct("slot", "piece", "size"))).alias("took")
        )
        after = state.join(took, "bin", "left").select(
            "bin", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap"), F.col("gap").alias("was"), "took"
        )
        after = scratch.write(after.filter(F.col("took").isNotNull() | (F.col("gap") >= shortest)), "bins")
        placed.append(after.filter(F.col("took").isNotNull()).select("bin", "was", "took"))
        gaps = after.filter(F.col("gap") >= shortest).select("bin", "gap")
        again = alone.select(F.col("piece").alias("id"), F.col("size").alias("length"))
        both = gaps.select(F.lit(GAP).alias("kind"), F.col("gap").alias("size")).unionByName(again.select(F.lit(PIECE).alias("kind"), F.col("length").alias("size")))
        room, waiting = Counter(), Counter()
        for r in both.groupBy("kind", "size").agg(F.count("*").alias("n")).collect():  # at most 2 * max_len rows
            (room if r["kind"] == GAP else waiting)[r["size"]] = r["n"]
    if not placed:
        return spark.createDataFrame([], "id long, sequence_id long, offset long")
    rounds = placed[0]
    for more in placed[1:]:
        rounds = rounds.unionByName(more)
    own = rounds.select("bin", "was", "took", F.posexplode("took").alias("k", "t"))
    before = F.aggregate(F.slice("took", 1, F.col("k")), F.lit(0).cast("long"), lambda a, t: a + t["size"])
    return own.select(F.col("t.piece").alias("id"), F.col("bin").alias("sequence_id"), (F.lit(max_len) - F.col("was") + before).alias("offset"))


def pack_best_fit(docs: DataFrame, tokenizer_file: str, max_len: int = 2048, end_id: int = 0) -> DataFrame:
    """Documents packed into few sequences of at most ``max_len`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, a row per piece.
    Null or empty texts are their end id alone; null or equal doc_ids are packed each on
    their own; repeated rows are rows like any other; an empty table gives no rows; other
    columns of ``docs`` are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "best_fit")
    pieces = scratch.write(cut_pieces(docs, tokenizer_file, max_len, end_id).withColumn("id", F.monotonically_increasing_id()), "pieces")
    found = pack(pieces.select("id", "length"), max_len, scratch)
    return pieces.join(found, "id").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
