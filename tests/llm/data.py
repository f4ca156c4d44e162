"""Small inputs with every awkward case the operators must take."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, row string, score double, ids string, lang string"


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def corpus(seed: int = 3, n: int = 60) -> list[tuple[int | None, str | None]]:
    """(doc_id, text): plain texts, exact and near copies, shared lines, and odd cases."""
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = []
    shared = " ".join(words(rng, 30))
    for k in range(n):
        lines = [" ".join(words(rng, rng.randrange(3, 25))) for _ in range(rng.randrange(1, 9))]
        if k % 4 == 0:
            lines.insert(rng.randrange(len(lines) + 1), shared)
        if k % 7 == 0:
            lines.insert(0, "")
        rows.append((k, "\n".join(lines)))
    for k in range(12):
        rows.append((1000 + k, rows[k % 5][1]))  # exact copies
        near = rows[k][1].split(" ")
        if len(near) > 20:
            near[len(near) // 2] = "changed"
            rows.append((2000 + k, " ".join(near)))
    rows += [
        (3000, None), (3001, ""), (3002, " \n\t "), (3003, "one two"), (3004, "one two"), (3005, "ONE two"),
        (None, "a null id with some words in it"), (None, rows[2][1]), (None, None), (3006, rows[3][1]), (3006, rows[3][1]),
        (3007, " ".join(words(rng, 6000))), (3008, "é ü 中文 😀 \x85 \xa0 ﬁ <|endoftext|> x<|endoftext|>\n\n  z"),
        (3009, "\n".join(["same line again and again with quite a few words in it"] * 40)),
    ]
    return rows


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """Rows as a table with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "r", 0.5, None, "en") for i, t in rows], DOCS).repartition(5)


@pytest.fixture
def docs(spark):
    return documents(spark, corpus())


@pytest.fixture
def no_docs(spark):
    return documents(spark, [])
