"""Registered queries and the pipeline's stages on the smallest tables."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from wishrank.llm import line_dedup, minhash, toxicity
from wishrank.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

COLUMNS = {
    "op1_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op2_minhash": {"doc_id", "n_shingles", "component_id", "kept"},
    "op3_embed_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op4_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op5_license_scan": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op6_line_dedup": {"doc_id", "n_lines", "n_deleted", "kept_bytes", "text_crc32"},
    "op7_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op8_piece_codec": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op9_ann": {"query_id", "rank", "vec_id", "score"},
    "op10_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op11_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    "op12_turn_repair": {
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    },
    "op13_best_fit": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
}
#: Rows of a query over a table of n rows, where that is not n.
ROWS = {
    "op1_packing": lambda n, got: got >= n,
    "op9_ann": lambda n, got: got == 5 * -(-n // 50),
    "op11_whitening": lambda n, got: got == 32 * n,
    "op13_best_fit": lambda n, got: got >= n,
}
TABLE = {"op3_embed_dedup": "embeddings", "op9_ann": "embeddings", "op11_whitening": "embeddings", "op12_turn_repair": "conversations"}


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    got = QUERIES[name](spark, SF)
    assert COLUMNS[name] <= set(got.columns)
    table = spark.read.parquet(f"{SF}/{TABLE.get(name, 'documents')}.parquet")
    rows = (table.select("conv_id").distinct() if name == "op12_turn_repair" else table).count()
    assert ROWS.get(name, lambda n, got: got == n)(rows, got.count())


def test_pipeline_is_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        counts.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] >= counts[3]
    key = lambda df: sorted(map(tuple, df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()))
    assert key(corpus_pipeline.run(spark, SF)) == key(docs)


def test_stages_take_no_rows(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name


def test_stages_apply_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    scored = toxicity.score_documents(docs, labels)
    assert ids(stages["toxicity"](spark, docs, SF)) == ids(scored.filter("predicted = 0"))
    lines = line_dedup.dedup_lines(docs).collect()
    left = [(r.row.doc_id, r.text) for r in lines if not r.n_units_deleted or r.text.split()]
    got = stages["line_dedup"](spark, docs, SF)
    assert sorted(map(tuple, got.select("doc_id", "text").collect())) == sorted(left) and len(left) < len(lines)
    groups = minhash.group_documents(docs)
    assert ids(stages["minhash"](spark, docs, SF)) == ids(groups.filter("rid = keep_rid"))
