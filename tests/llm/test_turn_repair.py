"""Operator 12 against damage in plain Python and a search over whole edit sequences."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wishrank.llm import turn_repair
from wishrank.llm.queries import op12_turn_repair

ROWS = "conv_id long, turn long, role string, text string, gone string, part int"
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(rows):
    for conv_id, turn, role, text in rows:
        said = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{said(conv_id)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv_id, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def plain(rows):
    """The result for ``(turn, role, text)`` in order: cheapest first, then the least audit."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, settled = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, k, q, out = heapq.heappop(heap)
        if (k, q) in settled:
            continue
        settled.add((k, q))
        if k == len(rows) and q in ("", "a"):
            break

        def push(more, label, to, line):
            state = step.get((q, line[0][:1])) if line else q
            if state is not None:
                heapq.heappush(heap, (cost + more, audit + label, to, state, out + ((line,) if line else ())))

        for role in ("user", "assistant"):
            push(2, "I", k, (role, ""))
        if k < len(rows):
            _, role, text = rows[k]
            push(3, "D", k + 1, None)
            if faults[k] not in ("b", "d"):
                worse = faults[k] == "t"
                push(int(worse), "K", k + 1, (role, text))
                for new in ("user", "assistant"):
                    push(2 + worse, "R", k + 1, (new, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    lines = "\n".join(f"{role}:{text}" for role, text in out)
    return (gaps, *(faults.count(c) for c in "bdt"), illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def expected(rows):
    by = {r[0]: [] for r in rows}
    for conv_id, *row in damaged(rows):
        by[conv_id].append(tuple(row))
    return {k: plain(sorted(v, key=lambda r: (r[0] is not None, r[0] or 0))) for k, v in by.items()}


def found(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, "g", 7) for r in rows], ROWS).repartition(parts)
    out = turn_repair.repair_conversations(turn_repair.damage(df)).collect()
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: tuple(r)[1:] for r in out}


TURNS = st.tuples(
    st.one_of(st.none(), st.integers(-2, 6)),
    st.sampled_from(["user", "assistant", "system", "user", "assistant", "tool", "", " ", "User", "sue"]),
    st.sampled_from(["a.", "b", "c!", "d? ", "", " \n\t", "e\xa0", ".", "é."]),
)


@given(st.lists(TURNS, max_size=14), st.sampled_from([1, 2, 5, 64]))
@settings(max_examples=400, deadline=None)
def test_one_conversation(rows, block):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    size, turn_repair.BLOCK = turn_repair.BLOCK, block
    try:
        assert turn_repair.repair(rows) == plain(rows)
    finally:
        turn_repair.BLOCK = size


def test_auction_prices_are_distances():
    """Of every node, against a relaxation until nothing changes."""
    rng = random.Random(8)
    for _ in range(200):
        rows = [(rng.choice("suaxx"), rng.random() < 0.3, rng.random() < 0.4) for _ in range(rng.randrange(1, 9))]
        end = tuple(rng.choice([0, 3, 7, turn_repair.FAR]) for _ in range(4))
        lattice = turn_repair.Lattice(rows, end)
        far = [turn_repair.FAR] * (4 * len(rows)) + list(end)
        for _ in range(len(far) + 1):
            for node, arcs in enumerate(lattice.arcs):
                far[node] = min(turn_repair.FAR, *(cost + far[j] for _, cost, j in arcs))
        assert [lattice.auction(k) for k in range(4 * len(rows))] == far[: 4 * len(rows)]


def test_conversations(spark):
    rng = random.Random(6)
    rows = []
    for conv_id in [*range(60), None]:
        for turn in rng.sample(range(20), rng.randrange(1, 12)):
            rows.append((conv_id, turn, rng.choice(["user", "assistant", "system", None, "x", ""]), rng.choice([None, "yes.", "no", "so?", f"t{turn}!", "é 中文", ""])))
    assert found(spark, rows) == expected(rows)


def test_long_conversations_over_partitions(spark, monkeypatch):
    """One conversation holds most rows; blocks, bounds and partitions cut it anywhere."""
    monkeypatch.setattr(turn_repair, "BLOCK", 7)
    monkeypatch.setattr(turn_repair, "LONG", 20)
    rng = random.Random(7)
    rows = [(rng.choice([None, 1, 1, 1, 1, 2, 3]), k, rng.choice(["user", "assistant", "user", "assistant", "system", None]), rng.choice(["a b.", "hello", "q?", f"t{k}.", f"u{k}", None])) for k in range(700)]
    assert found(spark, rows, 6) == expected(rows)
    copies = [(9, None, "user", "same.")] * 400  # wholly equal rows over many partitions
    assert found(spark, copies, 5) == expected(copies)


def test_repeated_turns_do_not_depend_on_partitions(spark):
    rows = [(1, 2, role, f"{k % 5}.") for k, role in enumerate(["user", "assistant", "system"] * 20)]
    assert found(spark, rows, 1) == found(spark, rows[::-1], 7)


def test_nothing_left_and_no_rows(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "x.")]) == {gone: (0, 0, 0, 0, 0, 0, "", EMPTY)}
    assert found(spark, [(None, None, None, None)]) == expected([(None, None, None, None)])
    assert found(spark, []) == {}


def test_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "?"), (1, 1, "assistant", "y" * 500_000)]
    assert found(spark, rows) == expected(rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = op12_turn_repair(spark, path)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r["conv_id"]: tuple(r)[1:] for r in out.collect()} == expected(rows)
