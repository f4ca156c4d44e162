"""Operator 7: token counts without token ids.

A tokenizer's pieces never cross the boundaries of its pre-tokens, so a pre-token
has the same number of pieces wherever it stands.  Pieces are counted once per
distinct pre-token of the whole corpus, and a document's count is the sum over its
pre-token frequencies.

The pre-token here is a space-led word.  Where every white space is a single space or
line end between two words, the tokenizer's own pattern starts a pre-token at each of
them, after each line end, and between a letter and a closing full stop or comma.  Its
pieces do not cross those cuts, and cutting there needs no regular expression.  Texts
with other white space are cut by the pattern itself.

Steps, each over all rows:

1. Distinct chunks with their corpus frequency: each task adds up its chunks, Spark
   adds up the tasks.  Chunks and piece counts are written as a stage.
2. The most frequent chunks, at most ``FREQUENT`` of them (a proven bound), are
   broadcast with their counts; hot chunks never travel.
3. One pass turns a document into a row with the sum over its frequent chunks, and
   a row for each of its other chunks; written as a stage.
4. Those other, rare, chunks join the counts on the chunk, and a partial sum per
   document closes the count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import Scratch, slices

#: Chunks that are broadcast with their counts (about 30 MB in a worker).
FREQUENT = 200_000
#: Longer chunks are never broadcast.
SENT_BYTES = 64
#: Distinct chunks that a task adds up before it hands them on.
FLUSH = 200_000


def _pattern():
    import regex

    # \s of the library is Unicode white space, without the separators 0x1C-0x1F.
    return regex.compile(bpe.PATTERN.replace(r"[^\s\p{L}", r"[^\p{White_Space}\p{L}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def chunks(text: str, pattern) -> list[str]:
    """Pre-tokens of a text without special strings; their concatenation is the text."""
    if not text:
        return []
    if text.replace("\n", " ").split(" ") != text.split():
        return pattern.findall(text)  # runs of white space, or white space at an end
    out: list[str] = []
    lead = ""
    for line in text.split("\n"):
        if lead:
            out.append("\n")
            lead = ""
        for word in line.split(" "):
            if word[-1] in ".," and word[:-1][-1:].isalpha():
                out.append(lead + word[:-1])
                out.append(word[-1])
            else:
                out.append(lead + word)
            lead = " "
    return out


def _pieces(rank_file: str):
    enc = bpe.load(rank_file)
    return lambda chunk: len(enc.encode_ordinary(chunk))


def count_tokens(
    docs: DataFrame,
    rank_file: str,
    limit: int = 1024,
    frequent: int = FREQUENT,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null text counts as empty (0 bytes, 0 tokens).  Rows are counted one by one, so
    repeated or null doc_ids give a row each; an empty table gives no rows; other
    columns are ignored.  The special string of the vocabulary counts as one token.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "token_counts")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, seen = _pattern(), Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(list(seen), type=pa.string()), pa.array(list(seen.values()), type=pa.int64())], names=["chunk", "n"])
            seen.clear()
            return batch

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                for part in (text or "").split(bpe.SPECIAL):
                    seen.update(chunks(part, pattern))
                if len(seen) > FLUSH:
                    yield flushed()
        yield flushed()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(rank_file)
        for batch in batches:
            n = pa.array([pieces(c) for c in batch.column(0).to_pylist()], type=pa.int64())
            yield pa.record_batch([*batch.columns, n], names=["chunk", "n", "pieces"])

    counted = texts.select("text").mapInArrow(add_up, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    known = scratch.write(counted.mapInArrow(measure, "chunk string, n long, pieces long"), "chunks")
    # The largest frequency classes that hold at most ``frequent`` chunks together.
    # Long chunks (whole lines of texts without spaces) always join, so what is sent is bounded in bytes.
    leveled = known.filter(F.octet_length("chunk") <= SENT_BYTES).withColumn("level", F.floor(F.log2("n") * 8))
    room, least = frequent, 1 << 30
    for r in sorted(leveled.groupBy("level").count().collect(), key=lambda r: -r["level"]):
        if r["count"] > room:
            break
        room, least = room - r["count"], r["level"]
    top = {r["chunk"]: r["pieces"] for r in leveled.filter(F.col("level") >= least).select("chunk", "pieces").collect()}
    shared = spark.sparkContext.broadcast(top)

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, top = _pattern(), shared.value
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        for batch in slices(batches):
            rows = []
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                parts = text.split(bpe.SPECIAL)
                tokens, rare = len(parts) - 1, Counter()
                for part in parts:
                    found = chunks(part, pattern)
                    counts = list(map(top.get, found))
                    if None in counts:
                        rare.update(c for c, n in zip(found, counts) if n is None)
                        tokens += sum(n for n in counts if n is not None)
                    else:
                        tokens += sum(counts)
                rows.append((row, doc_id, len(text.encode()), tokens, None, None))
                rows.extend((row, None, None, None, c, n) for c, n in rare.items())
            columns = list(zip(*rows)) or [()] * 6
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(columns, types)], names=["row", "doc_id", "n_bytes", "tokens", "chunk", "freq"])

    split = scratch.write(
        texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
            per_document, "row long, doc_id long, n_bytes long, tokens long, chunk string, freq long"
        ),
        "documents",
    )
    rare = (
        split.filter("chunk IS NOT NULL")
        .select("row", "chunk", "freq")
        .join(known.select("chunk", "pieces"), "chunk")
        .select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"), (F.col("freq") * F.col("pieces")).alias("tokens"))
    )
    whole = split.filter("chunk IS NULL").select("row", "doc_id", "n_bytes", "tokens")
    return (
        whole.unionByName(rare)
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("tokens").alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
