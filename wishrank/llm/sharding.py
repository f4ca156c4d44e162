"""Operator 4: shuffle all rows into a fixed number of shards (DataFrame functions only).

A two-pass external shuffle.  The first pass scatters whole records uniformly into
memory-sized buckets by a seeded hash; the second shuffles each bucket in memory
(Fisher-Yates, Spark's ``shuffle`` with a seed) and writes it.  Reading the buckets one
after the other gives a uniform permutation of all rows, and shard ``s`` is the
``s``-th of ``n`` runs of that permutation, with row counts at most one apart.

* The hash is taken over the row's position in its input split, so equal rows, null
  ids and a source that holds a third of all rows scatter like any others.
  The position is stable for files and written tables; stage other inputs first.
* The number of buckets grows with the input's bytes, so a bucket stays the size of
  ``bucket_bytes``.  A task reads its buckets sorted by bucket (Spark spills there) and
  holds one at a time, so shuffle partitions may hold many: beyond ``PARTITIONS`` of
  them, they take more buckets each.
* Bucket sizes are turned into start positions by running sums in two levels (within
  ``GROUP`` buckets, then over groups), so no task reads all of them at scale.
* The shuffled buckets are a written table: positions drawn once stay, and a lost
  executor repeats only its own buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch

#: Buckets whose sizes are summed in one window group.
GROUP = 1_000
#: Bucket starts that are broadcast.
BROADCAST_BUCKETS = 1_000_000
#: Shuffle partitions of the first pass, at most.
PARTITIONS = 50_000


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: strings and binaries by length, arrays and maps by entries."""
    parts = [F.lit(64).cast("long")]
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            size = F.octet_length(F.array_join(c, "")) + 16 * F.size(c)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            size = 16 * F.size(c)
        else:
            size = F.lit(8)
        parts.append(F.coalesce(F.greatest(size, F.lit(0)), F.lit(0)).cast("long"))
    return reduce(lambda a, b: a + b, parts)


def bucket_count(df: DataFrame, bucket_bytes: int) -> int:
    """Buckets of about ``bucket_bytes`` each: one narrow aggregate over all rows."""
    total = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return 1 + int(total // bucket_bytes)


@contextmanager
def one_group_at_a_time(spark: SparkSession) -> Iterator[None]:
    """Plan aggregates of lists over sorted rows, one group in memory, not over a hash map of groups."""
    name = "spark.sql.execution.useObjectHashAggregateExec"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def external_shuffle(df: DataFrame, seed: int, buckets: int, scratch: Scratch) -> DataFrame:
    """``df`` as column ``row``, with ``bucket`` and the place ``at`` (from 0) in its bucket."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    keyed = df.select(row.alias("row"), F.monotonically_increasing_id().alias("place"))
    scattered = keyed.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "place"), F.lit(buckets)))
    # Ordered input, a fixed number of partitions and a literal seed: the same rows
    # come out in the same order whenever a task runs again.
    gathered = (
        scattered.repartition(min(buckets, PARTITIONS), "bucket")
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list(F.struct("place", "row"))).alias("rows"))
        .sortWithinPartitions("bucket")
    )
    shuffled = gathered.select("bucket", F.shuffle("rows", seed).alias("rows"))
    flat = shuffled.select("bucket", F.posexplode("rows").alias("at", "item"))
    with one_group_at_a_time(df.sparkSession):
        return scratch.write(flat.select("bucket", F.col("at").cast("long").alias("at"), F.col("item.row").alias("row")), "buckets")


def bucket_starts(shuffled: DataFrame) -> tuple[DataFrame, int]:
    """Start position of every bucket in the permutation, and the number of rows."""
    sizes = shuffled.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("grp", F.floor(F.col("bucket") / GROUP))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.withColumn("inner", F.coalesce(F.sum("n").over(before("grp").orderBy("bucket")), F.lit(0)))
    groups = sizes.groupBy("grp").agg(F.sum("n").alias("n"))
    outer = groups.select("grp", F.coalesce(F.sum("n").over(before(F.lit(0)).orderBy("grp")), F.lit(0)).alias("outer"))
    starts = inner.join(outer, "grp").select("bucket", (F.col("inner") + F.col("outer")).alias("start"))
    total = groups.agg(F.sum("n")).first()[0] or 0
    return starts, total


def shuffle_into_shards(
    df: DataFrame,
    shards: int = 40,
    seed: int = 20_240_229,
    bucket_bytes: int = 16 << 20,
    scratch: Scratch | None = None,
) -> DataFrame:
    """All rows of ``df`` (struct column ``row``) with shard (0 to shards - 1) and slot.

    Shards are near equal in rows (at most one apart) and slots are gapless from 0.
    Nulls, empty texts and repeated rows are rows like any other; an empty table gives
    no rows; the columns of ``df`` stay inside ``row``, so no name can clash.
    """
    scratch = scratch or Scratch(df.sparkSession, "sharding")
    buckets = bucket_count(df, bucket_bytes)
    shuffled = external_shuffle(df, seed, buckets, scratch)
    starts, total = bucket_starts(shuffled)
    least, more = divmod(total, shards)  # the first `more` shards have one row extra
    place, head = F.col("start") + F.col("at"), more * (least + 1)
    shard = F.when(place < head, F.floor(place / (least + 1))).otherwise(more + F.floor((place - head) / max(least, 1)))
    first = F.when(F.col("shard") < more, F.col("shard") * (least + 1)).otherwise(head + (F.col("shard") - more) * least)
    # The number of buckets is known: up to a million starts (16 MB) are broadcast, so
    # the texts are not shuffled again; beyond it, they are joined.
    if buckets <= BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    return (
        shuffled.join(starts, "bucket")
        .select("row", place.alias("place"), shard.cast("int").alias("shard"))
        .select("row", "shard", (F.col("place") - first).alias("slot"))
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    sharded.select("row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot")).sortWithinPartitions(
        "_shard", "_slot"
    ).write.mode("overwrite").partitionBy("_shard").parquet(path)
