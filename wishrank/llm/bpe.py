"""Byte-level BPE ids and counts, equal to those of the tokenizers library.

The rank file and the JSON file hold the same vocabulary.  Ranks run several
times faster, so texts are encoded with them; the special string of the JSON
file is found first, as that library does, and takes its own id.  ``tests/llm``
holds the two against each other on arbitrary Unicode texts.
"""

from __future__ import annotations

import base64
from array import array

#: Fixed values of the vocabulary file: its split pattern and its special string.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


def load(rank_file: str):
    """An encoder of plain text (no special strings) from a rank file."""
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(enc, text: str) -> array:
    """The ids of ``text`` as unsigned 32-bit integers."""
    if SPECIAL not in text:
        return array("I", enc.encode_ordinary(text))
    ids = array("I")
    for k, part in enumerate(text.split(SPECIAL)):
        if k:
            ids.append(SPECIAL_ID)
        ids.extend(enc.encode_ordinary(part))
    return ids
