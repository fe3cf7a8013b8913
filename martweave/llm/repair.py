"""Repair of conversations whose turns are damaged, by the cheapest edits, with an audit of them.

The roles of a sound conversation begin ``s`` or nothing, then ``ua`` repeated, or it is empty. A row is kept,
given another role, or deleted, and rows may be inserted; each edit has a cost. What matters of a row
is one symbol: its role's initial and its fault. A symbol is a min-plus matrix over four states (nothing yet,
after ``s``, after ``u``, after ``a``), and a run of equal symbols is a power of it. Powers of two are kept, so a run of
any length costs a few products. Costs to go are carried from the end to the front over runs; then
choices are unrolled from the front, the least letter among the cheapest, and spell the audit.

Rows are shuffled by conversation twice: first their symbols, without texts, then texts with the audit
in front of them, so that the repaired text is hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martweave.llm.words import ship
from martweave.session import parked

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_FAR = np.int64(1) << np.int64(60)
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: State after a user or assistant row is put in, by state; after a row kept, by state and role.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_KEPT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_ENDS = (_START, _ASSISTANT)
_SEGMENT = 4096

# A symbol is 3 * role + fault: role 0 other, 1 s, 2 u, 3 a; fault 0 none, 1 truncated, 2 must go.
_ROLES = "?sua"


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), _FAR)


def _inserts() -> np.ndarray:
    """Cheapest insertions from state to state."""
    step = np.full((4, 4), _FAR)
    np.fill_diagonal(step, 0)
    for state, after in enumerate(_NEXT):
        step[state, after] = INSERT
    return _times(_times(step, step), step)


@lru_cache(maxsize=None)
def _edits(symbol: int) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state, what may be done with a row of the symbol: (letter, cost, state after), letters ascending."""
    role, fault = _ROLES[symbol // 3], symbol % 3
    out = []
    for state in range(4):
        own = [("D", DELETE, state)]
        if fault < 2:
            if (state, role) in _KEPT:
                own.append(("K", KEEP + TRUNCATED * fault, _KEPT[state, role]))
            own.append(("R", REROLE + TRUNCATED * fault, _NEXT[state]))
        out.append(tuple(own))
    return tuple(out)


@lru_cache(maxsize=None)
def _power(symbol: int, k: int) -> np.ndarray:
    """The transition of 2**k rows of one symbol: insertions, then an edit, for each."""
    if k:
        half = _power(symbol, k - 1)
        return _times(half, half)
    edit = np.full((4, 4), _FAR)
    for state, own in enumerate(_edits(symbol)):
        for _, cost, after in own:
            edit[state, after] = min(edit[state, after], cost)
    return _times(_inserts(), edit)


def _before(symbol: int, length: int, to_go: np.ndarray) -> np.ndarray:
    """Costs to go ahead of ``length`` rows of a symbol, given those behind them."""
    for k in range(length.bit_length()):
        if length >> k & 1:
            to_go = np.minimum((_power(symbol, k) + to_go[None]).min(axis=1), _FAR)
    return to_go


def _at_end() -> np.ndarray:
    return np.array([_inserts()[s, list(_ENDS)].min() for s in range(4)])


def repair_runs(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Least cost and least audit of a conversation given as runs (symbol, length)."""
    to_go = [_at_end()]
    for symbol, length in reversed(runs):
        to_go.append(_before(symbol, length, to_go[-1]))
    to_go.reverse()
    state, audit = _START, []
    for i, (symbol, length) in enumerate(runs):
        for left in range(length, 0, -_SEGMENT):
            own = min(left, _SEGMENT)
            after = [_before(symbol, left - own, to_go[i + 1])]
            for _ in range(own - 1):
                after.append(_before(symbol, 1, after[-1]))
            for costs in reversed(after):
                state, letters = _row(symbol, state, costs)
                audit.append(letters)
    while state not in _ENDS:
        audit.append("I")
        state = _NEXT[state]
    if not runs:
        return 0, ""
    return int(to_go[0][_START]), "".join(audit)


def _row(symbol: int, state: int, after: np.ndarray) -> tuple[int, str]:
    """The state behind a row and the letters that lead there, given the costs to go behind it."""
    return _row_by_values(symbol, state, *(int(c) for c in after - after.min()))


@lru_cache(maxsize=1 << 16)
def _row_by_values(symbol: int, state: int, *after: int) -> tuple[int, str]:
    edits, letters = _edits(symbol), ""
    direct = [min(cost + after[to] for _, cost, to in own) for own in edits]
    inserts = _inserts()
    best = [min(int(inserts[s, t]) + direct[t] for t in range(4)) for s in range(4)]
    while True:
        options = [(letter, to, False) for letter, cost, to in edits[state] if cost + after[to] == best[state]]
        if INSERT + best[_NEXT[state]] == best[state]:
            options.append(("I", _NEXT[state], True))
        letter, state, again = min(options)
        letters += letter
        if not again:
            return state, letters


@lru_cache(maxsize=1 << 14)
def _known(runs: tuple[tuple[int, int], ...]) -> tuple[int, str]:
    return repair_runs(list(runs))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after damage, chosen by a checksum of ``conv_id:turn``: of 20 cases, 0 drops the row,
    1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it the user's. NULL roles and texts, and
    NULLs in the checksum, are one space; a NULL conv_id or turn stays NULL."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    case, text = F.pmod(F.crc32(key.cast("binary")), F.lit(20)), F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(case == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(case == 0, F.array().cast("array<int>")).when(case == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("copies"),
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies")).drop("col")


def _order(columns: list[str]) -> list[Column]:
    return [F.asc_nulls_first(c) for c in columns]


def _dealt(rows: DataFrame, order: list[str], n_parts: int) -> DataFrame:
    return rows.repartition(n_parts, "conv_id").sortWithinPartitions(*_order(["conv_id", *order]))


def _audits(rows: DataFrame, n_parts: int) -> DataFrame:
    """Per conversation: counts, cost and audit, from symbols alone."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = rows.select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "role", F.xxhash64("text").alias("h1"), F.xxhash64(F.concat("text", F.lit("#"))).alias("h2"),
        F.when(end == "", 2).when(F.substring(end, -1, 1).isin(".", "!", "?"), 0).otherwise(1).alias("end"),
    )
    # Once dealt by conversation, the window and the final order need no shuffle of their own.
    dealt = light.repartition(n_parts, "conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "h1", "h2").orderBy(F.asc_nulls_first("turn"))) > 1
    role = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for c in "sua" for x in (c, _ROLES.index(c)))), F.col("initial")), F.lit(0))
    marked = dealt.withColumn("again", again).select(
        "conv_id", "turn", "initial", "role", "h1", "h2",
        F.when(F.col("end") == 2, 0).when(F.col("again"), 1).when(F.col("end") == 1, 2).otherwise(3).cast("int").alias("fault"), role.cast("int").alias("kind"),
    )
    sorted_ = marked.sortWithinPartitions(*_order(["conv_id", "turn", "role", "h1", "h2"])).select("conv_id", "turn", "initial", "fault", "kind")
    kinds = dict(rows.dtypes)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, own, now, id_type = [], None, None, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv_id, turn, initial, fault, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is None or conv_id != now:
                    if own is not None:
                        done.append((now, *own.result()))
                    own, now = _Conversation(), conv_id
                own.add(turn, initial, fault, kind)
            if len(done) > 1000:
                yield emit(done, id_type)
                done = []
        if own is not None:
            yield emit([*done, (now, *own.result())], id_type)

    def emit(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, *[pa.int64()] * 6, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)

    return sorted_.mapInArrow(run, f"conv_id {kinds['conv_id']}, " + ", ".join(f"{n} bigint" for n in names[1:7]) + ", audit string")


class _Conversation:
    """Counts and runs of the rows of one conversation, in order. Holds runs, not rows."""

    def __init__(self) -> None:
        self.faults, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.low = self.high = self.turn = None
        self.turns, self.runs = 0, []

    def add(self, turn: int | None, initial: str, fault: int, kind: int) -> None:
        self.faults[fault] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low, self.high, self.turn = (turn if self.low is None else self.low), turn, turn
        symbol = 2 if fault < 2 else 3 * kind + (fault == 2)
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += 1
        else:
            self.runs.append([symbol, 1])

    def result(self) -> tuple:
        runs = tuple((s, n) for s, n in self.runs)
        cost, audit = _known(runs) if len(runs) <= 64 else repair_runs(list(runs))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, *self.faults[:3], self.illegal, cost, audit


def _repaired(rows: DataFrame, audits: DataFrame, n_parts: int) -> DataFrame:
    """Rows (conv_id, repaired_sha256): the edits of each audit carried out on the rows in their order."""
    keyed = rows.select("conv_id", F.lit(1).alias("is_row"), "turn", "role", F.xxhash64("text").alias("h1"), F.xxhash64(F.concat("text", F.lit("#"))).alias("h2"), "text")
    heads = audits.select("conv_id", F.lit(0).alias("is_row"), F.lit(None).cast(dict(rows.dtypes)["turn"]).alias("turn"), F.lit("").alias("role"),
                          F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"), F.col("audit").alias("text"))
    ordered = _dealt(keyed.unionByName(heads), ["is_row", "turn", "role", "h1", "h2"], n_parts).select("conv_id", "is_row", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, done, id_type = None, None, [], None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv_id, is_row, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if is_row:
                    own.row(role, text)
                else:
                    if own is not None:
                        done.append((now, own.end()))
                    now, own = conv_id, Repair(text)
            if len(done) > 1000:
                yield emit(done, id_type)
                done = []
        if own is not None:
            yield emit([*done, (now, own.end())], id_type)

    def emit(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        ids, hashes = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(hashes, pa.string())], ["conv_id", "repaired_sha256"])

    return ordered.mapInArrow(run, f"conv_id {dict(rows.dtypes)['conv_id']}, repaired_sha256 string")


class Repair:
    """Carries out an audit row by row, hashing ``role:text`` lines as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.hash, self.lines = audit, 0, _START, hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def _put_in(self) -> str:
        self.state = _NEXT[self.state]
        return "user" if self.state == _USER else "assistant"

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line(self._put_in(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _KEPT[self.state, role[:1]]
            self._line(role, text)
        elif edit == "R":
            self._line(self._put_in(), text)

    def end(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


def repair(rows: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id, turn, role, text; other columns are ignored, and NULL roles and texts are one space. Order is by turn, NULL first; rows of one turn
    by role and a hash of the text, so equal ones stand together. A NULL conv_id is a conversation of its own.
    ``originals`` names conversations that may have lost all rows; they get zeros, an empty audit and the hash of nothing.
    An audit is one value, so a conversation of very many rows is streamed through one task, which holds its runs
    and its audit, never its texts.
    """
    spark = rows.sparkSession
    ship(spark)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blank = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    audits = parked(_audits(rows, n_parts), "audits")
    hashed = _repaired(rows, audits, n_parts).withColumnRenamed("conv_id", "of")
    found = audits.join(hashed, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    if originals is None:
        return found
    every = originals.select(F.col("conv_id").alias("of")).distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    empty = {n: F.lit(0).cast("bigint") for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return joined.select(F.col("of").alias("conv_id"), *(F.coalesce(n, v).alias(n) for n, v in empty.items()))
