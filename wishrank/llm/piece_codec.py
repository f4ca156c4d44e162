"""Operator 8: SentencePiece encoding with byte offsets, and decoding.

Encoding is offset-preserving.  The text is normalised here by longest-prefix
matches through the model's compiled character map (a double-array trie), the dummy
prefix and the space mark, and every byte of the normalised text records the byte of
the original it came from.  The library gives the ids; their pieces tile the
normalised text, so each piece is projected to a span of original bytes.

Both directions work on one text at a time and need no shuffle.  The model is a file
name and is loaded once per task.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: The mark that stands for a space in pieces.
MARK = "▁".encode()
#: Bytes of the distinct words and their ids that a task keeps, and what an entry takes beside them.
WORD_BYTES = 96 << 20
_ENTRY = 200
#: A text that words alone do not make up: space runs, spaces or line ends at the start, literal marks.
_ODD = re.compile("^[ \\n]| $|  | \\n|\\n |▁").search


class CharacterMap:
    """Longest-prefix replacements of a model's compiled character map.

    Layout of the public format: the byte length of the trie, the trie as 32-bit
    units, then the replacements as zero-ended strings.  An empty map replaces nothing.
    """

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.strings = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes matched at ``at`` and what replaces them; None without a match."""
        units, found, node = self.units, None, 0
        node ^= _offset(units[0])
        for k in range(at, len(text)):
            node ^= text[k]
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                found = k + 1 - at, self.strings[value : self.strings.index(b"\0", value)]
        return found


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 1 << 9) >> 6)


class Codec:
    """A loaded model: ids, spans and decoded texts of single texts."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.lib = SentencePieceProcessor(model_file=model_file)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if spec.remove_extra_whitespaces or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("this operator projects offsets for models that keep white space and mark it in front")
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix
        # Bytes of the normalised text that a piece covers; a byte piece covers one,
        # an unknown piece (0 here) what the others leave.
        byte, unknown = proto.SentencePiece.BYTE, proto.SentencePiece.UNKNOWN
        # No piece holds a line end or a mark behind another character, so no merge
        # crosses the place before a single space or a line end.
        pieces = [p.piece for p in proto.pieces]
        self.by_word = spec.add_dummy_prefix and not self.map.units and not any("\n" in p or "▁" in p.lstrip("▁") for p in pieces)
        self.words: dict[str, bytes] = {}
        self.held = 0
        self.width = np.array([1 if p.type == byte else 0 if p.type == unknown else len(p.piece.encode()) for p in proto.pieces], dtype=np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The library's ids of every text.

        Texts with single spaces are put together from the ids of their words, which
        the library encodes once per distinct word; others it encodes whole.
        """
        cut: list[list[str] | None] = []
        for text in texts:
            if not self.by_word or not text or _ODD(text):
                cut.append(None)
                continue
            first, *lines = text.split("\n")
            keys = first.split(" ")
            for line in lines:
                keys += ("\n" + line).split(" ")
            cut.append(keys)
        if self.held > WORD_BYTES:
            self.words.clear()
            self.held = 0
        new = list({k for keys in cut if keys for k in keys}.difference(self.words))
        for key, ids in zip(new, self.lib.encode(new, num_threads=1)):
            # In front of a line end the library's dummy prefix is a piece of its own.
            self.words[key] = array("i", ids[1:] if key[0] == "\n" else ids).tobytes()
            self.held += _ENTRY + len(key) + 4 * len(ids)
        get = self.words.__getitem__
        return [
            np.frombuffer(b"".join(map(get, keys)), dtype=np.int32) if keys else np.asarray(self.lib.encode(t), dtype=np.int32)
            for t, keys in zip(texts, cut)
        ]

    def normalise(self, text: str) -> tuple[int, np.ndarray]:
        """Length in bytes of the normalised text, and per byte of it (and its end)
        the offset of the original byte it came from."""
        raw = text.encode()
        if not raw:
            return 0, np.zeros(1, dtype=np.int64)
        if self.map.units:
            out, source = bytearray(), []
            at = 0
            while at < len(raw):
                n, new = self.map.longest(raw, at) or (_char_bytes(raw[at]), None)
                new = raw[at : at + n] if new is None else new
                out += new
                source += [at] * len(new)
                at += n
            normal, origin = np.frombuffer(bytes(out), dtype=np.uint8), np.array(source, dtype=np.int64)
        else:
            normal, origin = np.frombuffer(raw, dtype=np.uint8), np.arange(len(raw))
        repeat = np.where(normal == 0x20, len(MARK), 1)
        aligned = np.repeat(origin, repeat)
        if self.prefix:
            aligned = np.concatenate([np.zeros(len(MARK), dtype=np.int64), aligned])
        return len(aligned), np.append(aligned, len(raw))

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) original byte of every piece.

        A piece that covers only the dummy prefix has an empty span, and the pieces
        of one character (byte pieces) start at bytes of that character.
        """
        n, aligned = self.normalise(text)
        width = self.width[ids]
        if (unknown := np.flatnonzero(width == 0)).size:
            if unknown.size > 1:  # the library's own pieces say how long each is
                pieces = self.lib.encode(text, out_type=str)
                width[unknown] = [len(pieces[k].replace(" ", "▁").encode()) for k in unknown]
            else:
                width[unknown] = n - width.sum()
        ends = np.cumsum(width)
        if ends.size and ends[-1] != n:
            raise ValueError("pieces do not tile the normalised text")
        return aligned[ends - width], aligned[ends]


def _char_bytes(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def encode(df: DataFrame, model_file: str, text: str = "text", batch_texts: int = 256) -> DataFrame:
    """``df`` without ``text``, with ids, begins and ends (arrays, one entry per piece).

    ``begins`` and ``ends`` are byte offsets into the UTF-8 text.  Null and empty texts
    give empty arrays.  The other columns stay as they are; columns of ``df`` that are
    already named ids, begins or ends are replaced.
    """
    keep = [c for c in df.columns if c not in (text, "ids", "begins", "ends")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model_file)
        for batch in slices(batches, batch_texts):
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            ids = codec.encode(texts)
            spans = [codec.spans(t, i) for t, i in zip(texts, ids)]
            stops = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = [np.concatenate(xs).astype(np.int32, copy=False) for xs in (ids, [s[0] for s in spans], [s[1] for s in spans])]
            arrays = [pa.ListArray.from_arrays(pa.array(stops), pa.array(x, type=pa.int32())) for x in flat]
            yield pa.record_batch([*batch.columns[:-1], *arrays], names=[*keep, "ids", "begins", "ends"])

    schema = T.StructType([f for f in df.schema.fields if f.name in keep])
    for c in ("ids", "begins", "ends"):
        schema = schema.add(c, T.ArrayType(T.IntegerType()))
    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(run, schema)


def decode(df: DataFrame, model_file: str, ids: str = "ids", batch_texts: int = 256) -> DataFrame:
    """``df`` with ``decoded``, the library's text of the id array ``ids`` (null: empty)."""
    names = [c for c in df.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model_file)
        for batch in slices(batches, batch_texts):
            rows = batch.column(names.index(ids))
            texts = [codec.lib.decode(r.values.to_numpy().tolist()) if r.is_valid and len(r) else "" for r in rows]
            yield pa.record_batch([*batch.columns, pa.array(texts, type=pa.string())], names=[*names, "decoded"])

    schema = T.StructType([f for f in df.schema.fields if f.name in names]).add("decoded", "string")
    return df.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)
