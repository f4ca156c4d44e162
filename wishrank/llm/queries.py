"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    best_fit,
    embed_dedup,
    license_scan,
    line_dedup,
    minhash,
    packing,
    piece_codec,
    sharding,
    token_counts,
    toxicity,
    turn_repair,
    whitening,
)
from .common import table, tokenizer_path
from .oracles import ORACLES as ORACLES

PIECE_MODEL = "piece_bpe_32k.model"
BPE_RANKS = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json as ranks
WORD_BPE = "word_bpe_49k.json"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(BPE_RANKS))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash.group_documents(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return groups.select("doc_id", "n_shingles", "component_id", kept)


def op3_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = embed_dedup.link_vectors(table(spark, sf_dir, "embeddings"))
    return links.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.col("row.text")
    return sharding.shuffle_into_shards(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = F.col("places")
    return license_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places["first"]).alias("first_word"),
        F.array_max(places["first"]).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(places["label"])), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return line_dedup.dedup_lines(docs, keep=["doc_id"]).select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        "n_lines",
        "n_deleted",
        "n_units_deleted",
        F.octet_length(text).cast("long").alias("kept_bytes"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(BPE_RANKS))


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path(PIECE_MODEL)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = piece_codec.decode(piece_codec.encode(docs, model), model)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("covered_bytes"),
    )


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_conversations(turn_repair.damage(table(spark, sf_dir, "conversations")))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_best_fit(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_minhash": op2_minhash,
    "op3_embed_dedup": op3_embed_dedup,
    "op4_sharding": op4_sharding,
    "op5_license_scan": op5_license_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_piece_codec": op8_piece_codec,
    "op9_ann": op9_ann,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_turn_repair": op12_turn_repair,
    "op13_best_fit": op13_best_fit,
}
