"""Licence scan, sharding and toxicity against plain versions."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wishrank.llm import license_scan, sharding, toxicity
from wishrank.llm.common import Scratch

from .data import corpus, documents, docs, no_docs, words  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_places(text: str | None) -> list[tuple[int, str]]:
    w = WORD.findall((text or "").translate(LOWER))
    return sorted(
        (k, label) for phrase, label in license_scan.BASE.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()
    )


def test_license_scan(spark, no_docs):
    rng = random.Random(4)
    bits = ["mit", "license", "apache", "cc", "by", "gnu", "general", "public", "MIT-License", "CC BY-NC 4.0", "x", "é", "the", "\n", ",",
            "gnu general public license", "version 3"]
    rows = [(k, " ".join(rng.choice(bits) for _ in range(rng.randrange(0, 40)))) for k in range(300)]
    notice = license_scan.NOTICES["bsd-text"][0]
    rows += [(900, "a b " + notice + " c"), (901, notice.replace("binary", "very binary")), (902, None), (None, "Mit License"), (903, "")]
    got = license_scan.scan(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i, t in rows:
        r = by[i][0]
        assert [(p["first"], p["label"]) for p in r.places] == base_places(t)
        assert r.n_words == len(WORD.findall((t or "").translate(LOWER)))
        assert {p["label"] for p in r.places} <= set(r.labels) and r.labels == sorted(set(r.labels))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert by[900][0].labels == ["bsd-text"] and by[900][0].score == 1
    assert "bsd-text" not in by[901][0].labels  # a key phrase is broken
    assert by[None][0].labels == ["mit"]
    assert license_scan.scan(no_docs).collect() == []


@pytest.mark.parametrize("shards,bucket", [(7, 4096), (40, 1 << 20), (500, 512)])
def test_sharding(spark, docs, shards, bucket):
    rows = corpus()
    got = sharding.shuffle_into_shards(docs, shards, bucket_bytes=bucket).collect()
    count = lambda pairs: Counter((i, t) for i, t in pairs)
    assert count((r.row.doc_id, r.row.text) for r in got) == count(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))


def test_sharding_of_nothing_and_files(spark, docs, no_docs, tmp_path):
    assert sharding.shuffle_into_shards(no_docs).collect() == []
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.shuffle_into_shards(docs, 5), path)
    back = spark.read.parquet(path)
    assert back.count() == len(corpus()) and back.select("_shard").distinct().count() == 5


def test_sharding_starts_in_two_levels(spark, docs, monkeypatch):
    monkeypatch.setattr(sharding, "GROUP", 3)
    monkeypatch.setattr(sharding, "BROADCAST_BUCKETS", 0)
    got = sharding.shuffle_into_shards(docs, 3, bucket_bytes=1024).collect()
    assert len({(r.shard, r.slot) for r in got}) == len(corpus())


def test_many_buckets_in_few_partitions(spark, docs, monkeypatch):
    """Partitions that hold many buckets give the same rows and places (their order in a bucket
    is drawn per partition), and the same again on a second run; one bucket is in memory at a time."""
    name = "spark.sql.execution.useObjectHashAggregateExec"
    before = spark.conf.get(name)
    staged = Scratch(spark, "test").write(docs)
    plain = sharding.shuffle_into_shards(staged, 3, bucket_bytes=1024).collect()
    monkeypatch.setattr(sharding, "PARTITIONS", 2)
    few, again = (sharding.shuffle_into_shards(staged, 3, bucket_bytes=1024).collect() for _ in range(2))
    assert Counter(few) == Counter(again)
    assert Counter(r.row for r in few) == Counter(r.row for r in plain)
    assert sorted((r.shard, r.slot) for r in few) == sorted((r.shard, r.slot) for r in plain)
    assert spark.conf.get(name) == before
    with sharding.one_group_at_a_time(spark):
        plan = docs.groupBy("doc_id").agg(F.collect_list("text"))._jdf.queryExecution().toString()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan


def test_buckets_count_every_column(spark):
    schema = "a string, b binary, c array<string>, d array<double>, e long, `f g` map<int, int>"
    rows = [("x" * 5000, b"y" * 300, ["z" * 700], [1.0] * 10, 1, {1: 2}), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    sizes = [r[0] for r in df.select(sharding.row_bytes(df)).collect()]
    assert 6000 < sizes[0] < 6500 and 64 <= sizes[1] < 200
    assert sharding.bucket_count(df, 1000) == 1 + sum(sizes) // 1000
    assert sharding.bucket_count(df.limit(0), 1000) == 1


def test_sharding_uses_no_python(spark, docs):
    plan = sharding.shuffle_into_shards(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def labelled(spark, n=900, seed=8):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        toxic = rng.random() < 0.2
        w = words(rng, rng.randrange(5, 60), 300)
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vileword", "nastyname", "meanly"]))
        rows.append((k, " ".join(w)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_toxicity(spark, no_docs):
    rows, labels = labelled(spark)
    table = spark.createDataFrame([*labels, (None, 1), (5000, None), (5001, 7)], "doc_id long, toxic int")
    extra = [(9000, None), (9001, ""), (None, "vileword nastyname meanly vileword")]
    got = toxicity.score_documents(documents(spark, rows + extra), table).collect()
    assert len(got) == len(rows) + 3
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {k for k, _ in rows + extra if k is not None and zlib.crc32(str(k).encode()) % 4 == 2}
    known = [r for r in held if r.doc_id in truth]
    assert len(known) > 150 and sum(r.predicted == truth[r.doc_id] for r in known) >= 0.97 * len(known)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[9000].score == by[9001].score and by[9000].predicted == 0 and by[None].predicted == 1
    kept = toxicity.clean_documents(documents(spark, rows + extra), table)
    assert kept.columns == documents(spark, []).columns
    assert kept.count() == sum(r.predicted == 0 for r in got)
    assert toxicity.score_documents(no_docs, table).collect() == []


def plain_ftrl(rows, labels, size, s):
    """FTRL-proximal one coordinate at a time, as published; the last one is the bias."""
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(k):
        if k < size and abs(z[k]) <= s.l1:
            return 0.0
        shrunk = z[k] - (np.sign(z[k]) * s.l1 if k < size else 0.0)
        return -shrunk / ((s.beta + n[k] ** 0.5) / s.alpha + s.l2)

    for at, y in zip(rows, labels):
        at = [*at, size]
        w = {k: weight(k) for k in at}
        g = 1 / (1 + np.exp(-max(-30.0, min(30.0, sum(w.values()))))) - y
        for k in at:
            sigma = ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / s.alpha
            z[k] += g - sigma * w[k]
            n[k] += g * g
    return np.array(z), np.array(n), np.array([weight(k) for k in range(size + 1)])


def test_ftrl_equals_a_plain_loop():
    rng = np.random.default_rng(5)
    s = toxicity.Settings(bits=6)
    rows = [np.unique(rng.integers(0, 64, rng.integers(1, 12))) for _ in range(400)]
    labels = np.array([float(7 in r or rng.random() < 0.1) for r in rows])
    z, n = np.zeros(65), np.zeros(65)
    toxicity.fit_shard(rows, labels, z, n, s)
    want_z, want_n, want_w = plain_ftrl(rows, labels, 64, s)
    assert np.allclose(z, want_z, atol=1e-9) and np.allclose(n, want_n, atol=1e-9)
    model = toxicity.finish(z, n, s)
    dense = np.zeros(64)
    dense[model.index] = model.value
    assert np.allclose(dense, want_w[:64], atol=1e-5) and abs(model.bias - want_w[64]) < 1e-9
    assert 0 < len(model.index) < 64 and dense[7] > 0  # sparse, and the cause is found


def test_one_shard_is_a_plain_fit(spark):
    """A round of mixing with a single shard gives that shard's weights."""
    rows, labels = labelled(spark, 200)
    s = toxicity.Settings(bits=10, rounds=1, shard_rows=10_000)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, rows), table, settings=s)
    learn = [(k, t) for k, t in rows if zlib.crc32(str(k).encode()) % 4 != 2]
    learn.sort(key=lambda r: r[0] * 2654435761 % 4294967291)
    truth = dict(labels)
    want = plain_ftrl([np.unique(toxicity.coordinates(t, 10)) for _, t in learn], [truth[k] for k, _ in learn], 1024, s)[2]
    dense = np.zeros(1024)
    dense[model.index] = model.value
    # Coordinates that hardly moved are not sent; they have no weight either way.
    assert np.allclose(dense, want[:1024], atol=1e-5) and abs(model.bias - want[1024]) < 1e-6


def test_toxicity_learns_nothing_from_held_out_rows(spark):
    rows, labels = labelled(spark, 300)
    flipped = [(k, 1 - y if zlib.crc32(str(k).encode()) % 4 == 2 else y) for k, y in labels]
    scores = []
    for chosen in (labels, flipped):
        table = spark.createDataFrame(chosen, "doc_id long, toxic int")
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.score_documents(documents(spark, rows), table).collect()))
    assert scores[0] == scores[1]


def test_toxicity_bounds_its_sample_and_takes_no_labels(spark, docs):
    labels = spark.range(500).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    assert toxicity.sample_labels(labels, "toxic", 40).count() <= 40
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.5}
