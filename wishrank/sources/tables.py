"""Readers for the driver's Parquet tables.

Each reader selects only the columns the pipeline uses, so the Parquet scan's
``ReadSchema`` stays narrow and filters are pushed into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_size")
