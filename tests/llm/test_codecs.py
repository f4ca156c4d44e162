"""Packing, token counts and the piece codec against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wishrank.llm import bpe, packing, piece_codec, token_counts
from wishrank.llm.common import tokenizer_path

from .data import corpus, docs, no_docs  # noqa: F401

RANKS = tokenizer_path("byte_bpe_50k.tiktoken")
PIECES = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


ODD = ["a", "B", "é", ".", ",", "'", " ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "　", "​", "1", "½", "中", "😀", "'s", "▁", "the", " and", "<|endoftext|>", "<s>", "..."]
texts = st.one_of(st.lists(st.sampled_from(ODD), max_size=14).map("".join), st.text(max_size=30))


@settings(max_examples=400, deadline=None)
@given(texts)
def test_ids_and_counts_equal_the_library(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    enc, pattern = _loaded()
    assert bpe.encode(enc, text).tolist() == ids
    parts = text.split(bpe.SPECIAL)
    cut = [c for p in parts for c in token_counts.chunks(p, pattern)]
    assert "".join(cut) == "".join(parts)
    assert len(parts) - 1 + sum(len(enc.encode_ordinary(c)) for c in cut) == len(ids)


def _loaded(kept=[]):
    if not kept:
        kept += [bpe.load(RANKS), token_counts._pattern()]
    return kept


@settings(max_examples=400, deadline=None)
@given(texts)
def test_pieces_equal_the_library_and_tile_the_text(text):
    codec = _codec()
    (ids,) = codec.encode([text])
    assert ids.tolist() == codec.lib.encode(text)
    begins, ends = codec.spans(text, ids)
    raw = text.encode()
    if raw:
        assert ends[-1] == len(raw) and (begins <= ends).all() and (begins[1:] >= begins[:-1]).all()
    # Pieces that hold whole characters are the bytes of their span.
    for i, a, b in zip(ids.tolist(), begins.tolist(), ends.tolist()):
        piece = codec.lib.id_to_piece(i)
        if not codec.lib.is_byte(i) and b - a == len(piece.replace("▁", " ").encode()):
            assert raw[a:b].decode().replace("▁", " ") == piece.replace("▁", " ")


def _codec(kept=[]):
    if not kept:
        kept.append(piece_codec.Codec(PIECES))
    return kept[0]


def test_kept_words_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(piece_codec, "WORD_BYTES", 5000)
    codec, rng = piece_codec.Codec(PIECES), random.Random(2)
    for k in range(40):
        texts = [" ".join(f"w{rng.randrange(400)}" + "z" * (300 * (k % 3)) for _ in range(6)) + "\nend" for _ in range(3)]
        assert [i.tolist() for i in codec.encode(texts)] == codec.lib.encode(texts)
        assert codec.held < 5000 + 21 * 2000 and codec.held >= sum(len(w) + len(b) for w, b in codec.words.items())


def test_character_map_takes_the_longest_prefix():
    # A double array by hand: "a" -> "x", "ab" -> "yz".  Units: label, leaf flag, offset.
    units = [0] * 512
    root_offset = 256
    units[0] = root_offset << 10
    a = root_offset ^ ord("a")
    units[a] = ord("a") | 1 << 8 | (a ^ 40) << 10
    units[40] = 1 << 31 | 0  # value of "a"
    b = 40 ^ ord("b")
    units[b] = ord("b") | 1 << 8 | (b ^ 300) << 10
    units[300] = 1 << 31 | 2  # value of "ab"
    blob = np.array([4 * len(units), *units], dtype="<u4").tobytes() + b"x\0yz\0"
    m = piece_codec.CharacterMap(blob)
    assert m.longest(b"abc", 0) == (2, b"yz")
    assert m.longest(b"ac", 0) == (1, b"x")
    assert m.longest(b"cab", 0) is None
    assert m.longest(b"cab", 1) == (2, b"yz")


def compiled_map(rules: dict[bytes, bytes]) -> bytes:
    """A compiled character map of replacements (no zero bytes): a double array with one
    block of 256 units per trie node, and one leaf unit per rule."""
    nodes = sorted({k[:n] for k in rules for n in range(len(k) + 1)})
    # Children of a node sit at its block xor their byte; a block's place 0 is its leaf.
    block = {p: 256 * (k + 1) for k, p in enumerate(nodes)}
    units, strings = [0] * (256 * (len(nodes) + 1)), b""
    spot = {b"": 0}
    for p in nodes:
        if p:
            spot[p] = block[p[:-1]] ^ p[-1]
        jump = spot[p] ^ block[p]
        coded = jump << 10 if jump < 1 << 21 else (jump >> 8) << 10 | 1 << 9
        units[spot[p]] = coded | (p[-1] if p else 0) | (p in rules) << 8
        if p in rules:
            units[block[p]] = 1 << 31 | len(strings)
            strings += rules[p] + b"\0"
    return np.array([4 * len(units), *units], dtype="<u4").tobytes() + strings


RULES = {"ﬁ": "fi", "Ａ": "A", "a": "b", "ab": "the", "abc": "", "½": "1/2", "é": "e"}


@pytest.fixture(scope="module")
def mapped_model(tmp_path_factory) -> str:
    """The given model with a character map of its own."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.precompiled_charsmap = compiled_map({k.encode(): v.encode() for k, v in RULES.items()})
    path = tmp_path_factory.mktemp("model") / "mapped.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def plainly_mapped(text: str) -> tuple[str, list[int]]:
    """The text after longest-prefix replacement and, per byte of it, where it came from."""
    out, origin, at = "", [], 0
    while at < len(text):
        key = max((k for k in RULES if text.startswith(k, at)), key=len, default=text[at])
        new = RULES.get(key, key)
        origin += [len(text[:at].encode())] * len(new.encode())
        out, at = out + new, at + len(key)
    return out, origin


def test_a_character_map_moves_the_spans(mapped_model):
    codec, rng = piece_codec.Codec(mapped_model), random.Random(8)
    bits = [*RULES, " ", "  ", "x", "中", "😀", "the", "\n", "abab", "ca"]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 12)))
        (ids,) = codec.encode([text])
        assert ids.tolist() == codec.lib.encode(text)
        normal, origin = plainly_mapped(text)
        length, aligned = codec.normalise(text)
        # Spaces become marks of three bytes, and one stands in front.
        expected = [0] * 3 + [o for o, c in zip(origin, normal.encode()) for _ in range(3 if c == 0x20 else 1)]
        assert length == len(expected) and aligned.tolist() == expected + [len(text.encode())]
        if not normal:
            continue
        begins, ends = codec.spans(text, ids)
        assert (begins <= ends).all() and (begins[1:] == ends[:-1]).all() and ends[-1] == len(text.encode())


def test_encode_with_a_character_map(spark, docs, mapped_model):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=mapped_model)
    got = piece_codec.encode(docs, mapped_model).collect()
    expected = Counter((i, tuple(library.encode(t or ""))) for i, t in corpus())
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == expected
    last = Counter((i, len((t or "").encode())) for i, t in corpus() if t)
    assert Counter((r.doc_id, r.ends[-1]) for r in got if r.ends) == last


def test_fill_patterns_use_every_piece_once():
    rng = random.Random(1)
    for _ in range(60):
        top = rng.choice([8, 64, 2048])
        histogram = Counter(rng.randint(1, top) for _ in range(rng.randrange(0, 400)))
        patterns = packing.fill_patterns(dict(histogram), top)
        used = Counter()
        for lengths, n in patterns:
            assert n > 0 and sum(lengths) <= top
            for length in lengths:
                used[length] += n
        assert used == histogram
    assert packing.fill_patterns({}, 8) == []
    assert packing.fill_patterns({1: 10**9}, 2048)  # counts, not pieces
    with pytest.raises(ValueError):
        packing.fill_patterns({9: 1}, 8)


def test_packing(spark, docs, no_docs, library):
    expected = Counter()
    for i, t in corpus():
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for at in range(0, len(ids), 64):
            expected[i, at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes()), len(ids)] += 1
    rows = packing.pack_documents(docs, RANKS, max_len=64, keep_ids=True).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in rows)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.02 * total / 64 + 1
    assert packing.pack_documents(no_docs, RANKS).collect() == []


def test_ranks_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    pieces = spark.range(400).selectExpr("id", "if(id % 3 = 0, 5, 1 + id % 9) AS length", "id AS offset_").repartition(6)
    rows = packing.assign_sequences(pieces, max_len=16).collect()
    assert sorted(r.id for r in rows) == list(range(400))
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for pieces in filled.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *(n for _, n in pieces)])[:-1].tolist()
        assert sum(n for _, n in pieces) <= 16


@pytest.mark.parametrize("frequent", [0, 50, 200_000])
def test_token_counts(spark, docs, no_docs, library, frequent):
    got = Counter(map(tuple, token_counts.count_tokens(docs, RANKS, limit=100, frequent=frequent).collect()))
    expected = Counter()
    for i, t in corpus():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected[i, len((t or "").encode()), n, n > 100] += 1
    assert got == expected
    if frequent == 50:
        assert token_counts.count_tokens(no_docs, RANKS).collect() == []


def test_piece_codec(spark, docs, no_docs):
    lib = _codec().lib
    both = piece_codec.decode(piece_codec.encode(docs, PIECES), PIECES)
    assert set(both.columns) == {"doc_id", "row", "score", "lang", "ids", "begins", "ends", "decoded"}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = Counter((r.doc_id, tuple(r.ids), digest(r.decoded)) for r in both.collect())
    expected = Counter()
    for i, t in corpus():
        ids = lib.encode(t or "")
        expected[i, tuple(ids), digest(lib.decode(ids) if ids else "")] += 1
    assert got == expected
    assert piece_codec.encode(no_docs, PIECES).collect() == []


def test_long_chunks_are_joined_not_sent(spark):
    """Repeated long lines without spaces count right, whatever their frequency."""
    from .data import documents

    line = "中文" * 300
    rows = [(k, f"{line}\n{line}\nshort words {k % 3}") for k in range(40)]
    enc = bpe.load(RANKS)
    want = Counter((k, len(t.encode()), len(enc.encode_ordinary(t)), len(enc.encode_ordinary(t)) > 1024) for k, t in rows)
    assert Counter(map(tuple, token_counts.count_tokens(documents(spark, rows), RANKS).collect())) == want
