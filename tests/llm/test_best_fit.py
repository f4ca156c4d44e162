"""Operator 13 against the tokenizers library, sequential best-fit decreasing and plain sweeps."""

from __future__ import annotations

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wishrank.llm import best_fit
from wishrank.llm.common import Scratch, tokenizer_path

from .data import corpus, docs, documents, no_docs  # noqa: F401

MODEL = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(MODEL)


def sequential(lengths: list[int], room: int) -> int:
    """Sequences that best-fit decreasing needs, one document at a time."""
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, g in enumerate(gaps) if g >= n]
        if fits:
            k = min(fits, key=lambda k: gaps[k])
            gaps[k] -= n
        else:
            gaps.append(room - n)
    return len(gaps)


def filled(rows, room: int) -> dict[int, int]:
    """Tokens per sequence; offsets must be gapless from 0."""
    by = defaultdict(list)
    for sequence, offset, length in rows:
        by[sequence].append((offset, length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= room
    return {k: sum(n for _, n in own) for k, own in by.items()}


AWKWARD = st.lists(st.sampled_from([
    "word", "Word", "İ", "é", "é", "ΑΣ", "ς", " ", "  ", "\n", "\t", "\x85", "\xa0", "　", "\x1c", "'s", "don't", "x'LL",
    "12345", "١٢", "😀", "👩‍👩‍👧", "中文", "ﬁ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "a<|endoftext|>b", "̈", "̸", "Å", "Å", "ß", "\x00", "!?..", "-",
]), max_size=12)


@given(st.lists(st.one_of(AWKWARD.map("".join), AWKWARD.map(" ".join), st.text(max_size=40)), min_size=1, max_size=5))
@settings(max_examples=300, deadline=None)
def test_word_ids_equal_whole_texts(library, texts):
    words = best_fit.WordEncoder(MODEL)
    for text in texts:
        whole = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), dtype="<u4").tolist() == whole
        assert np.frombuffer(words.encode(text), dtype="<u4").tolist() == whole  # from the cache


def test_every_token_comes_out_of_its_own_merges():
    """Then merging by the rank of the joined bytes never differs from merging listed pairs."""
    words = best_fit.WordEncoder(MODEL)
    with open(MODEL, encoding="utf-8") as f:
        model = json.load(f)["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    rank = {m: k for k, m in enumerate(merges)}
    assert [model["vocab"][a + b] for a, b in merges] == list(range(512, 512 + len(merges)))  # ids in the order of merges
    assert len(words.ranks) == len(model["vocab"])
    for token in model["vocab"]:
        if token in ("<|startoftext|>", "<|endoftext|>"):
            continue
        ended = token.endswith("</w>")
        parts = list(token[:-4] if ended else token)
        parts[-1] += "</w>" * ended
        while len(parts) > 1:
            least = min(range(len(parts) - 1), key=lambda k: rank.get((parts[k], parts[k + 1]), 1 << 30))
            assert (parts[least], parts[least + 1]) in rank, token
            parts[least : least + 2] = [parts[least] + parts[least + 1]]
        assert parts == [token]


def test_plain_characters_are_cut_alike(library):
    """Every character of the fast path, alone and between letters, digits and marks."""
    words = best_fit.WordEncoder(MODEL)
    plain = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and words.plain(chr(c))]
    assert len(plain) > 30_000 and all(c in plain for c in "aZ09 éÉßñ.,'’ж中あ가\n")
    for around in ("{}", "a{}b", "1{}2", "!{}?", " {} ", "x {}{} y"):
        texts = [around.replace("{}", c) for c in plain]
        for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert np.frombuffer(words.encode(text), dtype="<u4").tolist() == want.ids, repr(text)


def test_cache_is_emptied_and_texts_are_cut(library, monkeypatch):
    monkeypatch.setattr(best_fit, "CACHE_BYTES", 1000)
    monkeypatch.setattr(best_fit, "STRETCH", 20)
    words = best_fit.WordEncoder(MODEL)
    for text in ("one two three " * 5 + "x" * 200, "αβγ δε ζη θι κλμ ν ξο " * 3, "one " + "й̈" * 300 + " four\n", "  " * 40):
        assert np.frombuffer(words.encode(text), dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert words.held < 3000


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(1, 12)), max_size=60), st.integers(1, 6))
@settings(max_examples=300, deadline=None)
def test_counts_match_as_one_sweep(rows, parts):
    """Local sweeps and counts give the matches of one sweep over all rows."""
    rows = sorted(((kind, k, size) for k, (kind, size) in enumerate(rows)), key=lambda r: (-r[2], r[0], r[1]))
    stack, whole = [], set()
    for kind, own, size in rows:
        if kind == best_fit.GAP:
            stack.append(own)
        elif stack:
            whole.add((own, stack.pop()))
    step = -(-len(rows) // parts) if rows else 1
    found, free, alone = set(), {}, {}
    for p, at in enumerate(range(0, len(rows), step)):
        free[p], alone[p] = [], []
        for kind, own, _ in rows[at : at + step]:
            if kind == best_fit.GAP:
                free[p].append(own)
            elif free[p]:
                found.add((own, free[p].pop()))
            else:
                alone[p].append(own)
    lines = best_fit.match_counts({p: (len(alone[p]), len(free[p])) for p in free})
    for p, at, q, end, n, _ in lines:
        found |= {(alone[p][at + i], free[q][end - 1 - i]) for i in range(n)}
    assert found == whole
    assert sorted(r for *_, n, first in lines for r in range(first, first + n)) == list(range(sum(line[4] for line in lines)))


@pytest.mark.parametrize("kind", ["uniform", "one length", "tiny", "large"])
def test_pack_uses_few_sequences(spark, kind):
    rng = random.Random(5)
    lengths = {
        "uniform": [rng.randrange(1, 257) for _ in range(1500)],
        "one length": [90] * 500 + [rng.randrange(1, 200) for _ in range(1000)],
        "tiny": [rng.randrange(1, 8) for _ in range(2000)],
        "large": [rng.randrange(100, 257) for _ in range(600)],
    }[kind]
    scratch = Scratch(spark, "test")
    rows = spark.createDataFrame(list(enumerate(lengths)), "id long, length long").repartition(4)
    out = best_fit.pack(scratch.write(rows), 256, scratch).collect()
    assert sorted(r["id"] for r in out) == list(range(len(lengths)))
    used = filled([(r["sequence_id"], r["offset"], lengths[r["id"]]) for r in out], 256)
    assert len(used) <= 1.01 * sequential(lengths, 256) + 1


def test_documents(spark, docs, library):  # noqa: F811
    out = best_fit.pack_best_fit(docs, MODEL, max_len=256, end_id=0).collect()
    filled([(r["sequence_id"], r["offset"], r["length"]) for r in out], 256)
    want = []
    for doc_id, text in corpus():
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 256)):
            part = np.asarray(ids[at : at + 256], dtype="<u4").tobytes()
            want.append((doc_id, k, at, len(part) // 4, zlib.crc32(part)))
    got = [tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in out]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert len({r["sequence_id"] for r in out}) <= sequential([r[3] for r in want], 256) + 2


def test_empty_table_and_wrong_lengths(spark, no_docs):  # noqa: F811
    assert best_fit.pack_best_fit(no_docs, MODEL).collect() == []
    scratch = Scratch(spark, "test")
    with pytest.raises(ValueError):
        best_fit.pack(scratch.write(spark.range(1).select("id", F.lit(9).cast("long").alias("length"))), 8, scratch)


def test_only_null_texts(spark):
    out = best_fit.pack_best_fit(documents(spark, [(None, None), (1, ""), (1, "  \n")]), MODEL).collect()
    assert sorted(r["offset"] for r in out) == [0, 1, 2] and {r["length"] for r in out} == {1}
    assert len({r["sequence_id"] for r in out}) == 1
