"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..plans.stages import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written stages of one operator run, in the folder all executors share.

    Writing a stage cuts its lineage: after a lost executor, only later stages
    run again, and they read the same rows (row numbers and partition ids that
    were written once never change).
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = os.path.join(checkpoint_root(spark), "llm", f"{what}-{uuid.uuid4().hex[:12]}")
        self._n = 0

    def write(self, df: DataFrame, name: str = "stage") -> DataFrame:
        self._n += 1
        path = os.path.join(self.root, f"{self._n:03d}-{name}")
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that few texts at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
