"""Operator 12: repair the turn structure of conversations at least cost.

A conversation is a lattice: node (r, q) means that r of its rows are settled and that the
roles so far leave state q (nothing yet, after ``s``, after ``u``, after ``a``).  Arcs are
the edits: Keep and Rerole settle a row and move the state, Delete settles it, Insert moves
the state alone.  The cheapest way through is found by the auction algorithm for shortest
paths (Bertsekas, 1991): a path grows from its origin along the arc whose cost and price are
least, or, where no arc is worth the node's price, the price rises and the path contracts by
a node.  Costs are integers and every cycle costs something, so it ends, and prices then are
distances along all cheapest paths.  Arcs whose cost is the fall of the price are tight; the
trace takes the ASCII-least tight arc after letting an auction from its end confirm it.

Long conversations are never gathered.  Rows are range-sorted by (conversation, turn), so a
conversation that a third of all rows belong to is spread over partitions:

1. A task reads its partition in order.  Conversations that lie inside it and have at most
   ``LONG`` rows are repaired there.  The first and the last of a partition, which may go on
   in others, and long ones are passed on as rows, numbered in blocks.
2. Of those, each block of rows is a task's group: auctions give its cost from every state to
   every state.  One ordered pass from the last block to the first (four prices at a time)
   gives the prices at each block's end.
3. One ordered pass over rows, with these prices, traces blocks one after another and keeps
   the hash of the repaired text as it grows.  A conversation's hash is a single chain by
   its definition; this pass holds one block at a time.

Duplicates of passed-on rows are found by an aggregate over hashes of role and text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices

#: Rows of a block, which one lattice spans.
BLOCK = 64
#: Rows of the longest conversation that is repaired where it is read.
LONG = 4096

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state after an inserted or re-roled row
ROLE = {USER: "user", ASSISTANT: "assistant"}
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {"su", "ua", "au"}
#: What the roles still need at the end of a conversation, by state: inserts and their cost.
CLOSE, CLOSE_COST = ("", "II", "I", ""), (0, 4, 2, 0)
DELETE_COST, REROLE_COST, INSERT_COST = 3, 2, 2
FAR = 1 << 40  # no way from here
WORD, STOP = re.compile(r"[^\x20\x09-\x0D]"), ".!?"
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# ---------------------------------------------------------------- the lattice
class Lattice:
    """Rows ``(initial, must go, truncated)`` and the price of each state after the last of them.

    Inserts come before a row, so those between two blocks belong to the later one.
    """

    def __init__(self, rows: list[tuple[str, bool, bool]], end: tuple[int, ...]):
        self.n, self.end = len(rows), end
        self.arcs: list[tuple[tuple[tuple[str, int, int], ...], ...]] = []
        for r, (initial, gone, truncated) in enumerate(rows):
            here, after = 4 * r, 4 * r + 4
            self.arcs += [
                tuple(
                    [("D", DELETE_COST, after + q), ("I", INSERT_COST, here + NEXT[q])]
                    + ([] if gone or (q, initial) not in MOVES else [("K", int(truncated), after + MOVES[q, initial])])
                    + ([] if gone else [("R", REROLE_COST + truncated, after + NEXT[q])])
                )
                for q in range(4)
            ]
        # First prices: what the rows cost whatever is done, which no arc undercuts, and
        # FAR where the end cannot be reached.
        price = [list(end)]
        least = min(end)
        for initial, gone, truncated in reversed(rows):
            least += DELETE_COST if gone else truncated
            after = price[-1]
            reach = [after[q] < FAR or any(after[t] < FAR for t in ([] if gone else [NEXT[q], MOVES.get((q, initial), NEXT[q])])) for q in range(4)]
            for _ in range(2):
                reach = [reach[q] or reach[NEXT[q]] for q in range(4)]
            price.append([least if ok else FAR for ok in reach])
        self.price = [p for level in reversed(price) for p in level]

    def auction(self, origin: int) -> int:
        """The distance from ``origin`` to the end; prices along cheapest paths become exact."""
        price, arcs, stop = self.price, self.arcs, 4 * self.n
        if price[origin] >= FAR:
            return FAR
        path = [origin]
        while True:
            node = path[-1]
            if node >= stop:
                return price[origin]  # the path is tight to the end
            best, to = FAR, -1
            for _, cost, j in arcs[node]:
                if cost + price[j] < best:
                    best, to = cost + price[j], j
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)

    def trace(self, state: int) -> tuple[str, int]:
        """The ASCII-least cheapest edits from a state before the first row, and the last state."""
        node, out = state, []
        self.auction(node)
        while node < 4 * self.n:
            for label, cost, j in self.arcs[node]:  # in the order D, I, K, R
                if cost + self.price[j] == self.price[node] and cost + self.auction(j) == self.price[node]:
                    out.append(label)
                    node = j
                    break
        return "".join(out), node - 4 * self.n


def between(rows: list[tuple[str, bool, bool]]) -> list[list[int]]:
    """Cost from every state before a block (outer) to every state after it."""
    out = [[FAR] * 4 for _ in range(4)]
    for last in range(4):
        lattice = Lattice(rows, tuple(0 if q == last else FAR for q in range(4)))
        for first in range(4):
            out[first][last] = lattice.auction(first)
    return out


def before(costs: list[list[int]], end: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(FAR, *(c + e for c, e in zip(line, end))) for line in costs)


class Repair:
    """Repairs one conversation block by block, in order."""

    def __init__(self):
        self.state, self.cost, self.audit, self.hash, self.started = START, 0, [], hashlib.sha256(), False

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.started else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.started = True

    def _insert(self) -> None:
        self.state = NEXT[self.state]
        self._line(ROLE[self.state], "")
        self.cost += INSERT_COST

    def block(self, rows: list[tuple[str, str, str | None]], end: tuple[int, ...]) -> None:
        """``rows``: (role, text, fault); ``end``: the price of each state after them."""
        plain = [(role[:1], fault in (BLANK, DUPLICATE), fault == TRUNCATED) for role, _, fault in rows]
        edits, _ = Lattice(plain, end).trace(self.state)
        self.audit.append(edits)
        left = iter(rows)
        for edit in edits:
            if edit == "I":
                self._insert()
                continue
            role, text, fault = next(left)
            if edit == "D":
                self.cost += DELETE_COST
                continue
            if edit == "R":
                self.state = NEXT[self.state]
                role = ROLE[self.state]
                self.cost += REROLE_COST
            else:
                self.state = MOVES[self.state, role[:1]]
            self.cost += fault == TRUNCATED
            self._line(role, text)

    def close(self) -> tuple[int, str, str]:
        self.audit.append(CLOSE[self.state])
        for _ in CLOSE[self.state]:
            self._insert()
        return self.cost, "".join(self.audit), self.hash.hexdigest()


class Counts:
    """Counts over rows ``(turn, role, fault)`` that come in order."""

    def __init__(self):
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
        self.illegal = self.turns = 0
        self.low = self.high = self.initial = None

    def add(self, turn: int | None, role: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        self.illegal += self.initial is not None and self.initial + role[:1] not in LEGAL
        self.initial = role[:1]
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1

    def row(self) -> tuple[int, ...]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal


def fault_of(text: str) -> str | None:
    """Blank, truncated or neither."""
    last = text.rstrip(" \t\n\v\f\r")
    return BLANK if not last else None if last[-1] in STOP else TRUNCATED


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def repair(rows: list[tuple[int | None, str, str]]) -> tuple:
    """One whole conversation of ``(turn, role, text)`` in order: the result without conv_id."""
    counts, seen, marked = Counts(), set(), []
    for turn, role, text in rows:
        fault = fault_of(text)
        if fault != BLANK:
            key = _digest(role, text)
            fault = DUPLICATE if key in seen else fault
            seen.add(key)
        counts.add(turn, role, fault)
        marked.append((role, text, fault))
    blocks = [marked[at : at + BLOCK] for at in range(0, len(marked), BLOCK)]
    ends = [CLOSE_COST]
    for block in reversed(blocks[1:]):
        ends.append(before(between([(role[:1], fault in (BLANK, DUPLICATE), fault == TRUNCATED) for role, _, fault in block]), ends[-1]))
    out = Repair()
    for block, end in zip(blocks, reversed(ends)):
        out.block(block, end)
    return (*counts.row(), *out.close())


# ---------------------------------------------------------------- damage
def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``gone``: rows damaged by the CRC of ``conv_id:turn``.

    Nulls count as one space, but stay null as a turn.  Dropped rows stay, marked.
    """
    conv_id, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    filled = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled(conv_id), F.lit(":"), filled(turn)).cast("binary")) % 20
    text = filled(F.col("text"))
    rows = conversations.select(
        conv_id.alias("conv_id"),
        turn.alias("turn"),
        F.when(kind == 4, "user").otherwise(filled(F.col("role"))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
    )
    return rows.drop("_copy")


def _key(role: Column, text: Column) -> Column:
    """Order of rows of one turn: by their content, so equal rows are adjacent."""
    return F.xxhash64(role, text)


# ---------------------------------------------------------------- the job
PASSED = "conv_id long, part int, block long, k int, turn long, role string, text string, gone boolean, fault string, digest binary"


def _read_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole short conversations as results (``done``), the others as rows (``passed``)."""
    part = TaskContext.get().partitionId()
    done_names = [c.split()[0] for c in RESULT.split(", ")]
    passed_names = [c.split()[0] for c in PASSED.split(", ")]
    done_type = pa.struct([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in done_names])
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    passed_type = pa.struct([(n, kinds[c.split()[1]]) for n, c in zip(passed_names, PASSED.split(", "))])
    done: list[dict] = []
    passed: list[dict] = []
    held: list[tuple] = []  # rows of the current conversation
    current, passing, block, k, size = None, False, -1, 0, 0

    def flush() -> pa.RecordBatch:
        n, m = len(done), len(passed)
        columns = [pa.array(done + [None] * m, type=done_type), pa.array([None] * n + passed, type=passed_type)]
        done.clear()
        passed.clear()
        return pa.record_batch(columns, names=["done", "passed"])

    def give(row: tuple) -> None:
        nonlocal block, k
        if k % BLOCK == 0:
            block += 1
        conv_id, turn, role, text, gone = row
        fault = fault_of(text)
        digest = None if gone or fault == BLANK else _digest(role, text)
        passed.append(dict(zip(passed_names, (conv_id, part, block, k, turn, role, text, gone, fault, digest))))
        k += 1

    def finish() -> None:
        if not passing:
            rows = [(turn, role, text) for _, turn, role, text, gone in held if not gone]
            done.append(dict(zip(done_names, (current, *repair(rows)))))
        held.clear()

    first = True
    for batch in slices(batches, 256):
        for row in zip(*(batch.column(c).to_pylist() for c in range(5))):
            if first or row[0] != current:
                if not first:
                    finish()
                # The partition's first conversation may have begun in another one.
                current, passing, k, size, first = row[0], first, 0, 0, False
            size += len(row[3])
            if not passing and (len(held) >= LONG or size > 1 << 24):
                passing = True
                for r in held:
                    give(r)
                held.clear()
            if passing:
                give(row)
            else:
                held.append(row)
        if done or passed:
            yield flush()
    if not passing:  # the last one may go on in the next partition
        for r in held:
            give(r)
    if passed:
        yield flush()


def _block_costs(batch: pa.Table) -> pa.Table:
    """Of one block of rows: its costs from state to state."""
    rows = sorted(batch.select(["k", "role", "fault"]).to_pylist(), key=lambda r: r["k"])
    costs = between([(r["role"][:1], r["fault"] in (BLANK, DUPLICATE), r["fault"] == TRUNCATED) for r in rows])
    first = batch.select(["conv_id", "part", "block"]).slice(0, 1).combine_chunks()
    return first.append_column("costs", pa.array([sum(costs, [])], type=pa.list_(pa.int64())))


def _prices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks from the last to the first: the price of each state after the block."""
    current, end, first = None, CLOSE_COST, True
    for batch in batches:
        out = []
        for conv_id, costs in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if first or conv_id != current:
                current, end, first = conv_id, CLOSE_COST, False
            out.append(list(end))
            end = before([costs[at : at + 4] for at in range(0, 16, 4)], end)
        yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(out, type=pa.list_(pa.int64()))], names=["conv_id", "part", "block", "end"])


def _trace_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, with the prices at their block's end, to a result per conversation."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    types = [pa.string() if n in ("audit", "repaired_sha256") else pa.int64() for n in names]

    def rows():
        columns = ["conv_id", "part", "block", "turn", "role", "text", "fault", "end"]
        for batch in slices(batches, 256):
            yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns))

    for conv_id, own in groupby(rows(), key=lambda r: r[0]):
        counts, out = Counts(), Repair()
        for _, block in groupby(own, key=lambda r: r[1:3]):
            kept = [r for r in block if r[7] is not None]  # no prices: only dropped rows
            for _, _, _, turn, role, _, fault, _ in kept:
                counts.add(turn, role, fault)
            if kept:
                out.block([(role, text, fault) for _, _, _, _, role, text, fault, _ in kept], tuple(kept[0][7]))
        row = (conv_id, *counts.row(), *out.close())
        yield pa.record_batch([pa.array([v], type=t) for v, t in zip(row, types)], names=names)


def repair_conversations(rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text, gone); see ``RESULT``.

    Rows marked ``gone`` only name their conversation.  Null turns come first; rows of one
    turn are ordered by a hash of role and text, so repeated rows are adjacent and the
    result does not depend on partitions.  Null conv_ids are one conversation.  A role may
    be any string: only its initial counts, and an empty role is legal nowhere.  A
    conversation without rows has zeros, an empty audit and the hash of an empty string; an
    empty table gives no rows.
    """
    scratch = scratch or Scratch(rows.sparkSession, "turn_repair")
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), _key(F.col("role"), F.col("text")), F.col("gone"), F.col("_row")]
    sorted_ = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = sorted_.select("conv_id", "turn", "role", "text", "gone")
    both = scratch.write(sorted_.mapInArrow(_read_sorted, f"done struct<{_fields(RESULT)}>, passed struct<{_fields(PASSED)}>"), "read")
    done = both.filter(F.col("done").isNotNull()).select("done.*")
    passed = both.filter(F.col("passed").isNotNull()).select("passed.*")

    # Duplicates: rows that are not the first with their digest.
    place = F.struct("part", "block", "k")
    own = passed.filter(F.col("digest").isNotNull())
    firsts = own.groupBy("conv_id", "digest").agg(F.min(place).alias("first"))
    again = own.select("conv_id", "part", "block", "k", "digest").join(
        firsts.withColumnRenamed("conv_id", "c").withColumnRenamed("digest", "d"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    )
    again = again.filter(F.struct("part", "block", "k") != F.col("first")).select("part", "block", "k", F.lit(True).alias("again"))
    marked = passed.drop("digest").join(again, ["part", "block", "k"], "left")
    marked = scratch.write(marked.withColumn("fault", F.when(F.col("again"), F.lit(DUPLICATE)).otherwise(F.col("fault"))).drop("again"), "marked")

    alive = marked.filter(~F.col("gone")).select("conv_id", "part", "block", "k", "role", "fault")
    costs = alive.groupBy("part", "block").applyInArrow(_block_costs, "conv_id long, part int, block long, costs array<long>")
    back = [F.col("conv_id"), F.desc("part"), F.desc("block")]
    prices = costs.repartition("conv_id").sortWithinPartitions(*back).mapInArrow(_prices, "conv_id long, part int, block long, end array<long>")
    prices = scratch.write(prices, "prices").drop("conv_id")
    traced = (
        marked.join(prices, ["part", "block"], "left")
        .select("conv_id", "part", "block", "k", "turn", "role", "text", F.when(~F.col("gone"), F.col("fault")).alias("fault"), F.when(~F.col("gone"), F.col("end")).alias("end"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "block", "k")
        .mapInArrow(_trace_rows, RESULT)
    )
    return done.unionByName(traced)


def _fields(schema: str) -> str:
    return ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in schema.split(", "))
