"""Conversation repair: the cheapest edits that give a conversation alternating turns, by a dynamic program over runs.

A row is reduced to a symbol: its role's initial and its fault. Equal rows are counted before anything is shuffled by
conversation, so that a row repeated a million times is one run of a symbol. Equal consecutive symbols are one run. The program
has four states (nothing yet, after system, user or assistant); a symbol's transition is a 4 x 4 matrix of least costs,
and a run of n symbols multiplies the costs by that matrix's n-th power in min-plus algebra, put together from powers of
two that are kept for all conversations of a task. The edits are then unrolled from the first row on: of those that keep the
least cost, the first in ASCII order. Costs are kept without what all states have in common, so few different ones occur
within a run, and what follows from each is looked up.

Rows' texts take part twice only: as digests where repeats are looked for, and in a stream ordered by conversation
and turn, in which the edits of a conversation come before its rows and the repaired rows are hashed as they pass. A task holds
the symbols' runs and the edits of one conversation, which are part of its result, but never its texts.

Defined results: null roles and texts, and null ids and turns in the checksum, are one space. Rows of a turn are ordered by role
and md5 of the text, so repeated rows stand together; null turns come first. A null id is a conversation of its own. A role is judged
by its first character; an empty role has none. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantlake.llm.common import WHITE, partitions, store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ENDS = ".!?"
FAULTS = ("", "blank", "duplicate", "truncated")
# States: nothing yet, after system, after user, after assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state after an empty turn that is put in, or a row whose role is changed; its role is the state's.
TURNED = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: The state after a row that is kept, by its role's initial.
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
FINAL = (NONE, ASSISTANT)
FAR = 1 << 60
Symbol = tuple[str, int]


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, times): each row harmed by the checksum of its id and turn; ``times`` copies stand together.

    Of a dropped row only its id stays, with no copies.
    """
    space = F.lit(" ")
    given = rows.select(
        F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), space).alias("role"), F.coalesce(F.col(f"`{text}`"), space).alias("text"),
    )
    name = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    harmed = given.withColumn("harm", (F.crc32(name.cast("binary")) % 20).cast("int"))
    stays = F.col("harm") != 0
    text_ = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return harmed.select(
        "conv", F.when(stays, F.col("turn")).alias("turn"),
        F.when(stays, F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))).alias("role"), F.when(stays, text_).alias("text"),
        F.when(F.col("harm") == 3, 2).when(stays, 1).otherwise(0).cast("bigint").alias("times"),
    )


def _fault(text: Column, seen: Column) -> Column:
    body = F.rtrim(text, F.lit(WHITE))
    return F.when(body == "", 1).when(seen, 2).when(~F.right(body, F.lit(1)).isin(*ENDS), 3).otherwise(0)


def judged(harmed: DataFrame) -> DataFrame:
    """Equal rows once, with ``times``, the fault of the first of them, and the digest that orders rows of one turn."""
    equal = harmed.groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("times"))
    earlier = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    return equal.withColumn("seen", earlier).select(
        "conv", "turn", "role", "text", "times", _fault(F.col("text"), F.col("seen")).alias("fault"), F.md5("text").alias("digest")
    )


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least costs of a way through one matrix, then the other."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


@lru_cache(maxsize=1)
def _inserts() -> np.ndarray:
    """Least costs from state to state by empty turns alone."""
    one = np.full((4, 4), FAR, dtype=np.int64)
    for q in STATES:
        one[q, q] = 0
        one[q, TURNED[q]] = INSERT
    return _product(_product(one, one), one)


def _edits(symbol: Symbol, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row that may follow in a state: letter, cost, next state."""
    initial, fault = symbol
    edits = [("D", DELETE, state)]
    if FAULTS[fault] not in ("blank", "duplicate"):
        extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
        if initial in KEPT[state]:
            edits.append(("K", KEEP + extra, KEPT[state][initial]))
        edits.append(("R", REROLE + extra, TURNED[state]))
    return edits


@lru_cache(maxsize=4096)
def power(symbol: Symbol, two: int) -> np.ndarray:
    """Transition of 2**two equal rows, each after the empty turns that may come before it."""
    if two:
        half = power(symbol, two - 1)
        return _product(half, half)
    step = np.full((4, 4), FAR, dtype=np.int64)
    for q in STATES:
        for _, cost, after in _edits(symbol, q):
            step[q, after] = min(step[q, after], cost)
    return _product(_inserts(), step)


def advanced(symbol: Symbol, n: int, costs: np.ndarray) -> np.ndarray:
    """Costs to the end from before a run of ``n`` equal rows, given those from behind it."""
    two = 0
    while n >> two:
        if n >> two & 1:
            costs = np.minimum((power(symbol, two) + costs).min(axis=1), FAR)
        two += 1
    return costs


def repair(runs: list[tuple[Symbol, int]]) -> tuple[int, str]:
    """Least cost, and of the edits that have it the first in ASCII order."""
    end = (_inserts()[:, list(FINAL)]).min(axis=1)
    behind = [end]
    for symbol, n in reversed(runs):
        behind.append(advanced(symbol, n, behind[-1]))
    behind.reverse()
    state, letters = NONE, []
    for (symbol, n), after in zip(runs, behind[1:]):
        state = _unroll(symbol, n, state, after, letters)
    while state not in FINAL:
        letters.append("I")
        state = TURNED[state]
    return int(behind[0][NONE]), "".join(letters)


Costs = tuple[int, ...]


def _shape(costs: np.ndarray) -> tuple[int, Costs]:
    """What costs have in common, and the rest of each."""
    least = int(costs.min())
    return least, tuple((costs - least).tolist())


@lru_cache(maxsize=1 << 14)
def _before(symbol: Symbol, after: Costs) -> tuple[int, Costs]:
    """Costs before a row, from those behind it."""
    return _shape((power(symbol, 0) + np.array(after)).min(axis=1))


@lru_cache(maxsize=1 << 16)
def _choice(symbol: Symbol, state: int, after: Costs) -> tuple[str, int]:
    """The letters that bring a state past one row, given the costs behind it, and the state then."""
    more, rest = _before(symbol, after)
    here = [more + x for x in rest]
    letters = ""
    while True:
        options = [(letter, then) for letter, cost, then in _edits(symbol, state) if cost + after[then] == here[state]]
        if INSERT + here[TURNED[state]] == here[state]:
            options.append(("I", TURNED[state]))
        letter, state = min(options)
        letters += letter
        if letter != "I":
            return letters, state


def _unroll(symbol: Symbol, n: int, state: int, behind: np.ndarray, letters: list[str]) -> int:
    """Append the letters of a run and give the state behind it."""
    after = [_shape(behind)[1]]
    for _ in range(n - 1):
        after.append(_before(symbol, after[-1])[1])
    for costs in reversed(after):
        piece, state = _choice(symbol, state, costs)
        letters.append(piece)
    return state


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Conversation:
    """What is kept of a conversation while its rows pass: runs and counts."""

    def __init__(self, conv):
        self.conv = conv
        self.runs: list[list] = []
        self.counts = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = None
        self.initial: str | None = None

    def add(self, turn: int | None, initial: str, fault: int, times: int) -> None:
        if not times:  # dropped
            return
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.illegal += times - 1  # no role may follow itself
        self.initial = initial
        # Copies of a row that is not blank are duplicates of it.
        for n, kind in ((1, fault), (times - 1, fault if fault == 1 else 2)):
            if n:
                self.counts[kind] += n
                if self.runs and self.runs[-1][0] == (initial, kind):
                    self.runs[-1][1] += n
                else:
                    self.runs.append([(initial, kind), n])

    def row(self) -> tuple:
        cost, audit = repair([(symbol, n) for symbol, n in self.runs])
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv, gaps, *self.counts[1:], self.illegal, cost, audit)


def _batch(rows: list[tuple], like: pa.DataType, names: list[str]) -> pa.RecordBatch:
    """Rows that begin with an id."""
    kinds = {"audit": pa.string(), "repaired_sha256": pa.string(), "conv": like}
    return pa.RecordBatch.from_arrays([pa.array(x, kinds.get(c, pa.int64())) for c, x in zip(names, zip(*rows))], names)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and turn."""
    held: _Conversation | None = None
    names = ["conv", *COUNTS, "audit"]
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "initial", "fault", "times")]
        for conv, *row in zip(*columns):
            if held is None or held.conv != conv:
                if held:
                    done.append(held.row())
                held = _Conversation(conv)
            held.add(*row)
        kind = batch.schema.field("conv").type
        if done:
            yield _batch(done, kind, names)
    if held:
        yield _batch([held.row()], kind, names)


class _Repaired:
    """Hash of the repaired rows of a conversation as these pass."""

    def __init__(self, result: list):
        self.result, self.audit = result, result[-1]
        self.at, self.state = 0, NONE
        self.sha, self.any = hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.any = True

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = TURNED[self.state]
            self._put(ROLE_OF[self.state], "")
            self.at += 1

    def add(self, role: str, text: str, times: int) -> None:
        for _ in range(times):
            self._insert()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.state = KEPT[self.state][role[:1]]
                self._put(role, text)
            elif letter == "R":
                self.state = TURNED[self.state]
                self._put(ROLE_OF[self.state], text)

    def row(self) -> tuple:
        self._insert()
        return (*self.result, self.sha.hexdigest())


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation, its edits first, then by turn."""
    held: _Repaired | None = None
    given = ["conv", *COUNTS, "audit"]
    names = [*given, "repaired_sha256"]
    for batch in batches:
        done = []
        results = zip(*[batch.column(c).to_pylist() for c in given])
        rows = zip(*[batch.column(c).to_pylist() for c in ("role", "text", "times")])
        for result, row in zip(results, rows):
            if result[-1] is not None:
                if held:
                    done.append(held.row())
                held = _Repaired(list(result))
            else:
                held.add(*row)
        kind = batch.schema.field("conv").type
        if done:
            yield _batch(done, kind, names)
    if held:
        yield _batch([held.row()], kind, names)


def repaired(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation of ``rows``, which are as they came: see ``damaged`` for the harm done to them first.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    n = partitions(rows.sparkSession)
    known = store(judged(damaged(rows, conv_id, turn, role, text)), "turns")
    by_turn = ("conv", F.col("turn").asc_nulls_first(), "role", "digest")
    results = f"conv {rows.schema[conv_id].dataType.simpleString()}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string"

    symbols = known.select("conv", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "fault", "times")
    in_order = symbols.repartition(n, "conv").sortWithinPartitions(*by_turn).select("conv", "turn", "initial", "fault", "times")
    audits = in_order.mapInArrow(_audits, results)

    stream = audits.withColumn("first", F.lit(0)).unionByName(
        known.where("times > 0").select("conv", "turn", "role", "digest", "text", "times").withColumn("first", F.lit(1)), allowMissingColumns=True
    )
    stream = stream.repartition(n, "conv").sortWithinPartitions("conv", "first", *by_turn[1:])
    hashed = stream.select("conv", *COUNTS, "audit", "role", "text", "times").mapInArrow(_hashes, f"{results}, repaired_sha256 string")
    return hashed.withColumnRenamed("conv", conv_id)
