"""Operator 5: licence scans by a positional rare-token index.

Templates (licence notices and short phrases) are indexed by their words: a word's
postings are its places in the templates.  A file is looked up by the words of each
template with the highest IDF over the corpus; every place of such a word in the file
proposes a start (its place minus the posting's).  Only starts on which a template's
rare words agree, within a small slip for inserted or dropped words, are followed up:
the template's mandatory key phrases must stand there word for word.

* IDF is counted over all documents, for the templates' own words (about 200, whatever
  the corpus), by a partial aggregate.
* The second pass looks up whole texts; it needs no shuffle, and the index it carries
  depends on the templates alone.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Openings of public licence texts, with the phrases that must stand in them.
NOTICES = {
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ["permission is hereby granted free of charge", "deal in the software without restriction"],
    ),
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license version 2 0"]),
    "gpl-2.0": ("licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    "gpl-3.0": ("licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    "lgpl": ("under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    "agpl": ("under the terms of the gnu affero general public license", ["gnu affero general public license"]),
    "bsd-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ["redistribution and use in source and binary forms", "provided that the following conditions are met"],
    ),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    "cc-by-nc": ("licensed under cc by nc 4 0", ["cc by nc"]),
    "cc-by-sa": ("licensed under cc by sa 4 0", ["cc by sa"]),
    "cc-by-nd": ("licensed under cc by nd 4 0", ["cc by nd"]),
    "cc0": ("released under cc0 1 0 universal public domain dedication", ["public domain dedication"]),
    "unlicense": (
        "this is free and unencumbered software released into the public domain",
        ["free and unencumbered software released into the public domain"],
    ),
}

#: Words of a template, by falling IDF, that a file is looked up by.
RARE = 4
#: Words by which two rare words may disagree about a start.
SLIP = 2

# A-Z to a-z; every byte that is no letter, digit or part of a longer character to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[int, tuple[bytes, ...]], ...]  # place in the template, words
    base: bool


def templates(base: dict[str, str], notices: dict[str, tuple[str, list[str]]]) -> list[Template]:
    def find(whole: tuple[bytes, ...], part: tuple[bytes, ...]) -> int:
        for k in range(len(whole) - len(part) + 1):
            if whole[k : k + len(part)] == part:
                return k
        raise ValueError(f"key phrase {part} is not in its template")

    out = [Template(label, w := tuple(words(phrase)), ((0, w),), True) for phrase, label in base.items()]
    for label, (text, keys) in notices.items():
        whole = tuple(words(text))
        out.append(Template(label, whole, tuple((find(whole, k := tuple(words(key))), k) for key in keys), False))
    return out


class Index:
    """Postings of the rarest words of every template, and what a match is worth."""

    def __init__(self, known: list[Template], idf: dict[bytes, float]):
        self.known = known
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.rare: list[frozenset[bytes]] = []
        self.weight = [{w: idf[w] for w in t.words} for t in known]
        for k, t in enumerate(known):
            # The rare words are taken from the key phrases: those must be present.
            must = sorted({w for _, key in t.keys for w in key}, key=lambda w: (-idf[w], w))[:RARE]
            self.rare.append(frozenset(must))
            for at, w in enumerate(t.words):
                if w in self.rare[k]:
                    self.postings[w].append((k, at))
        self.lookup = frozenset(self.postings)

    def starts(self, file: list[bytes]) -> Iterator[tuple[int, int]]:
        """(template, start) on which all its rare words agree within the slip."""
        if not self.lookup.intersection(file):
            return
        votes: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        for at, w in enumerate(file):
            if w in self.lookup:
                for k, place in self.postings[w]:
                    votes[k, at - place].add(w)
        for k, start in votes:
            near: set[bytes] = set()
            slip = 0 if self.known[k].base else SLIP
            for s in range(start - slip, start + slip + 1):
                near |= votes.get((k, s), set())
            if near == self.rare[k]:
                yield k, start

    def verified(self, file: list[bytes], k: int, start: int) -> bool:
        """Each key phrase stands word for word, within the slip of its place."""
        slip = 0 if self.known[k].base else SLIP
        for place, key in self.known[k].keys:
            if not any(
                s >= 0 and tuple(file[s : s + len(key)]) == key for s in range(start + place - slip, start + place + slip + 1)
            ):
                return False
        return True

    def share(self, file: list[bytes], k: int, start: int) -> float:
        """IDF-weighted share of the template's words found near their places."""
        t, weight, got = self.known[k], self.weight[k], 0.0
        for at, w in enumerate(t.words):
            lo = max(0, start + at - SLIP)
            got += weight[w] if w in file[lo : max(0, start + at + SLIP + 1)] else 0.0
        return min(1.0, got / sum(weight[w] for w in t.words))

    def scan(self, file: list[bytes]) -> tuple[list[tuple[str, int, int]], set[str], float]:
        """Base places (label, first, last word), all labels, best score."""
        places, labels, best = [], set(), 0.0
        for k, start in self.starts(file):
            if self.verified(file, k, start):
                t = self.known[k]
                labels.add(t.label)
                if t.base:
                    places.append((t.label, start, start + len(t.words) - 1))
                best = max(best, self.share(file, k, start))
        return places, labels, best


def word_idf(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, float]:
    """IDF of the templates' words over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, dict.fromkeys(vocabulary, 0)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                n += 1
                for w in vocabulary.intersection(words(text)):
                    seen[w] += 1
        keys = [None, *(w.decode() for w in seen)]
        yield pa.record_batch([pa.array(keys, type=pa.string()), pa.array([n, *seen.values()], type=pa.int64())], names=["word", "n"])

    sums = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    count = {r["word"]: r["n"] for r in sums}
    total = count.get(None, 0)
    return {w: math.log1p(total / (1 + count.get(w.decode(), 0))) + 1e-6 for w in vocabulary}


def scan(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, tuple[str, list[str]]] = NOTICES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, places (label, first and last word of each
    base phrase, by first word), labels (sorted) and score (0 to 1, the best
    IDF-weighted share of a verified template; 0 without one).

    Null and empty texts have no words, places or labels.  Rows are scanned one by one,
    so repeated and null doc_ids give a row each; an empty table gives no rows; other
    columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = templates(base, notices)
    index = Index(known, word_idf(texts, frozenset(w for t in known for w in t.words)))
    place = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
    types = [pa.int64(), pa.int64(), pa.list_(place), pa.list_(pa.string()), pa.float64()]
    names = ["doc_id", "n_words", "places", "labels", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = words(text)
                places, labels, score = index.scan(file)
                places.sort(key=lambda p: (p[1], p[0]))
                rows.append((doc_id, len(file), [dict(zip(("label", "first", "last"), p)) for p in places], sorted(labels), score))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

    return texts.mapInArrow(
        run, "doc_id long, n_words long, places array<struct<label: string, first: long, last: long>>, labels array<string>, score double"
    )
