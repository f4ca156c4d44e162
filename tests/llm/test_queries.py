"""Every column that the queries of operators 4 to 8 return, against plain versions on whole tables."""

from __future__ import annotations

import hashlib
import os
import zlib

import pyarrow.parquet as pq
import pytest

from wishrank.llm import line_dedup
from wishrank.llm.common import tokenizer_path
from wishrank.llm.queries import QUERIES

from .test_scans import LOWER, WORD, base_places

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def texts() -> dict[int, str | None]:
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(zip(t["doc_id"], t["text"]))


def rows(spark, name: str) -> dict[int, dict]:
    got = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
    by_id = {r["doc_id"]: r for r in got}
    assert len(by_id) == len(got)
    return by_id


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())


def test_sharding_columns(spark, texts):
    got = rows(spark, "op4_sharding")
    assert set(got) == set(texts)
    slots: dict[int, list[int]] = {k: [] for k in range(40)}
    for i, r in got.items():
        assert (r["size"], r["text_crc32"]) == (len((texts[i] or "").encode()) + 16, crc(texts[i]))
        assert (r["law"], r["grown_shard"]) == ("rows", None)
        slots[r["shard"]].append(r["slot"])
    counts = [len(s) for s in slots.values()]
    assert max(counts) - min(counts) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_license_columns(spark, texts):
    got = rows(spark, "op5_license_scan")
    assert set(got) == set(texts)
    for i, r in got.items():
        places = base_places(texts[i])
        starts, labels = [k for k, _ in places], sorted({label for _, label in places})
        assert r["n_words"] == len(WORD.findall((texts[i] or "").translate(LOWER)))
        assert (r["n_base"], r["first_word"], r["last_word"]) == (len(places), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(labels)
        every = r["labels"].split(",") if r["labels"] else []
        assert every == sorted(set(every)) and set(labels) <= set(every) and 0 <= r["score"] <= 1


def test_line_dedup_columns(spark, texts):
    got = rows(spark, "op6_line_dedup")
    assert set(got) == set(texts)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    left = {r.row.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    changed = 0
    for i, r in got.items():
        text = left[i].text
        assert (r["kept_bytes"], r["text_crc32"]) == (len((text or "").encode()), crc(text))
        assert (r["n_lines"], r["n_deleted"], r["n_units_deleted"]) == (left[i].n_lines, left[i].n_deleted, left[i].n_units_deleted)
        assert r["n_units_deleted"] or text == texts[i]
        changed += text != texts[i]
    assert changed


def test_token_count_columns(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    got = rows(spark, "op7_token_counts")
    assert set(got) == set(texts)
    for i, r in got.items():
        n = len(library.encode(texts[i] or "", add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((texts[i] or "").encode()), n, n > 1024)


def test_piece_columns(spark, texts):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    got = rows(spark, "op8_piece_codec")
    assert set(got) == set(texts)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for i, r in got.items():
        ids = library.encode(texts[i] or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(library.decode(ids) if ids else "")
        assert r["covered_bytes"] == len((texts[i] or "").encode())
