"""Repair of the turn structure of conversations by a run-length dynamic program.

A conversation should read as role initials ``(s?(ua)+)?``: an optional system
turn, then user and assistant in turn.  Every row may be kept (0), given the role
user or assistant (2) or deleted (3), and empty user or assistant turns may be
inserted anywhere (2).  Blank and duplicate rows must be deleted; a truncated row
that stays costs 1 more.  The cheapest edits are wanted, of equal ones those
whose letters ``D I K R`` sort first.

A row's symbol is its role (s, u, a or other) and its fault.  Equal consecutive
symbols form runs.  What a row does to the cost of each of the four states
(nothing yet, after s, after u, after a) is a 4 x 4 min-plus matrix, so a run of n
rows is that matrix's n-th power: the powers 2**k are cached per symbol, and a
conversation of any length takes a few products per run.  Costs to go are found
from the last run back; the choices are then unrolled from the first run on, by
halving runs with the same powers.

Equal rows are counted before any shuffle by conversation, and first
appearances are found by an aggregate per (conversation, role, text digest).
The counted rows, without texts, are sorted over range partitions, so one
conversation with a third of all rows is spread over many tasks, each of which
passes on runs.  The runs of a conversation meet in one row, as its audit must.
Texts are then streamed in order past the audit; no conversation is held.

Defined cases: rows are taken by turn (null first), equal turns by role and
the text's digest; a null role or text counts as one space; rows without a conv_id form one
conversation; a role counts by its first character, an empty one as another
role; a conversation without rows gets no row here; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved

# The costs of the edits and the white space of words.
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
SPACE = r"\x20\x09-\x0D"

ROLES = ("s", "u", "a", "")  # first characters; "" is any other
SOUND, TRUNCATED, DEAD = range(3)  # what a symbol says of its row; blank and duplicate rows are DEAD
_TURN = (2, 2, 3, 2)  # the state after one more user or assistant turn, per state
_END = (0, 4, 2, 0)  # what completes a conversation that ends in a state
_NEVER = 1 << 60

Vector = tuple[int, int, int, int]


def symbol(role: str, fault: int) -> int:
    kind = ROLES.index(role[:1]) if role[:1] in ROLES[:3] else 3
    return 3 * kind + fault


def _keep(sym: int, state: int) -> int | None:
    """The state after a row is kept, or None where it can't be."""
    kind, fault = divmod(sym, 3)
    if fault == DEAD:
        return None
    wanted = {0: (1, 2, None), 1: (None, 2, None), 2: (None, None, 3), 3: (None, 2, None)}[state]
    return wanted[kind] if kind < 3 else None


def _edits(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, by letter."""
    extra = CUT_SHORT if sym % 3 == TRUNCATED else 0
    out = [("D", DELETE, state)]
    if (to := _keep(sym, state)) is not None:
        out.append(("K", extra, to))
    if sym % 3 != DEAD:
        out.append(("R", REROLE + extra, _TURN[state]))
    return out


@lru_cache(maxsize=None)
def power(sym: int, k: int) -> tuple[Vector, ...]:
    """Costs between states over 2**k rows of a symbol (12 symbols, k below 64)."""
    if k == 0:
        rows = []
        for state in range(4):
            best, at, paid = [_NEVER] * 4, state, 0
            for _ in range(4):  # inserted turns before the row; more than three visit a state again
                for _, cost, to in _edits(sym, at):
                    best[to] = min(best[to], paid + cost)
                at, paid = _TURN[at], paid + INSERT
            rows.append(tuple(best))
        return tuple(rows)
    half = power(sym, k - 1)
    return tuple(tuple(min(half[x][z] + half[z][y] for z in range(4)) for y in range(4)) for x in range(4))


def before(sym: int, n: int, togo: Vector) -> Vector:
    """Costs to go before n rows of a symbol from those after them."""
    k = 0
    while n:
        if n & 1:
            m = power(sym, k)
            togo = tuple(min(m[x][y] + togo[y] for y in range(4)) for x in range(4))
        n, k = n >> 1, k + 1
    return togo


def _least_zero(togo: Vector) -> Vector:
    low = min(togo)
    return tuple(c - low for c in togo)


def _one(sym: int, state: int, togo: Vector) -> tuple[str, int]:
    """Letters up to and with the edit of one row, and the state after it."""
    now = before(sym, 1, togo)
    letters = ""
    while True:
        options = [(letter, cost + togo[to], to) for letter, cost, to in _edits(sym, state)]
        options.append(("I", INSERT + now[_TURN[state]], _TURN[state]))
        letter, _, to = min(o for o in options if o[1] == now[state])
        letters, state = letters + letter, to
        if letter != "I":
            return letters, state


@lru_cache(maxsize=1 << 16)
def _short(sym: int, n: int, state: int, togo: Vector) -> tuple[str, int]:
    if n == 1:
        return _one(sym, state, togo)
    second = n - n // 2
    left, state = _short(sym, n // 2, state, _least_zero(before(sym, second, togo)))
    right, state = _short(sym, second, state, togo)
    return left + right, state


def unroll(sym: int, n: int, state: int, togo: Vector) -> Iterator[tuple[str, int]]:
    """The letters of n rows of a symbol in pieces, with the state after each."""
    while n:
        step = 64 if n > 64 else n
        n -= step
        letters, state = _short(sym, step, state, _least_zero(before(sym, n, togo)))
        yield letters, state


def plan(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of runs (symbol, rows)."""
    togo = [_END]
    for sym, n in reversed(runs):
        togo.append(before(sym, n, togo[-1]))
    state, letters = 0, []
    for (sym, n), after in zip(runs, reversed(togo[:-1])):
        for part, state in unroll(sym, n, state, after):
            letters.append(part)
    letters.append("I" * (_END[state] // INSERT))
    return togo[-1][0], "".join(letters)


def _blank(text: str) -> Column:
    return ~F.col(text).rlike(f"[^{SPACE}]")


def _clean(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))


def _counted(rows: DataFrame) -> DataFrame:
    """Equal rows counted: conv_id, turn, role, key, n, blank, ended, first (whether role and text are new here)."""
    marked = rows.select("conv_id", "turn", "role", F.md5("text").alias("key"), _blank("text").alias("blank"),
                         F.col("text").rlike(rf"[.!?][{SPACE}]*\z").alias("ended"))
    rows = saved(marked.groupBy("conv_id", "turn", "role", "key", "blank", "ended").agg(F.count(F.lit(1)).alias("n")), "turn_rows")
    news = rows.groupBy("conv_id", "role", "key").agg(F.min(F.struct("turn")).alias("new")).toDF("c", "r", "k", "new")
    same = rows["conv_id"].eqNullSafe(news["c"]) & (rows["role"] == news["r"]) & (rows["key"] == news["k"])
    return rows.join(news, same).withColumn("first", F.col("turn").eqNullSafe(F.col("new.turn"))).drop("c", "r", "k", "new")


def _segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted rows in order -> one row (conv_id, runs) per conversation of a task."""
    conv, started, runs = None, False, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), pa.array([[r[0] for r in runs]], pa.list_(pa.int32())),
             pa.array([[r[1] for r in runs]], pa.list_(pa.int64()))], names=["conv_id", "symbols", "rows"])

    for batch in batches:
        kind = batch.column(0).type
        for c, role, n, blank, ended, first in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if started and c != conv:
                yield out()
                runs = []
            conv, started = c, True
            fault = DEAD if blank or not first else SOUND if ended else TRUNCATED
            for sym, k in ((symbol(role, fault), 1), (symbol(role, DEAD), n - 1)):
                if k and runs and runs[-1][0] == sym:
                    runs[-1][1] += k
                elif k:
                    runs.append([sym, k])
    if started:
        yield out()


_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _plans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for parts in batch.column(1).to_pylist():
            runs: list[list[int]] = []
            for part in parts:
                for sym, n in zip(part["symbols"], part["rows"]):
                    if runs and runs[-1][0] == sym:
                        runs[-1][1] += n
                    else:
                        runs.append([sym, n])
            kinds = [sym // 3 for sym, _ in runs]
            illegal = sum(n - 1 for _, n in runs) + sum(p not in _LEGAL for p in zip(kinds, kinds[1:]))
            found.append((illegal, *plan([(s, n) for s, n in runs])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))],
            names=["conv_id", "illegal", "cost", "audit"])


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text).

    conv_id, gaps (missing turn numbers), blank, duplicate, truncated (rows by
    their first fault), illegal (neighbours whose roles may not meet), cost and
    audit of the cheapest repair.
    """
    rows = saved(_counted(_clean(turns)), "counted")
    kind = turns.schema["conv_id"].dataType.simpleString()
    first = F.col("first").cast("long")
    sound = F.when(~F.col("blank"), F.lit(1)).otherwise(0) * first
    counts = rows.groupBy("conv_id").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("n") - first).otherwise(0)).alias("duplicate"),
        F.sum(F.when(~F.col("ended"), sound).otherwise(0)).alias("truncated"))
    numbers = rows.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    place = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "key"]
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    segments = (rows.select("conv_id", "role", "n", "blank", "ended", "first", "turn", "key")
                .repartitionByRange(n, *place).sortWithinPartitions(*place)
                .mapInArrow(_segments, f"conv_id {kind}, symbols array<int>, rows array<bigint>")
                .withColumn("part", F.spark_partition_id()))
    plans = (segments.groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("part", "symbols", "rows"))).alias("parts"))
             .mapInArrow(_plans, f"conv_id {kind}, illegal long, cost long, audit string"))
    out = plans
    for side, at in ((counts, "c"), (numbers, "d")):
        side = side.withColumnRenamed("conv_id", at)
        out = out.join(side, out["conv_id"].eqNullSafe(side[at])).drop(at)
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


_KEPT = "place long, edit string, role string, text string"


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each conversation's audit before them -> the repaired turns."""
    audit, at, state, place = "", 0, 0, 0
    names = {2: "user", 3: "assistant"}
    for batch in batches:
        out: list[tuple] = []

        def insert(conv):
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                state = _TURN[state]
                out.append((conv, place, "I", names[state], ""))
                at, place = at + 1, place + 1

        for conv, role, text, given in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if given is not None:
                audit, at, state, place = given, 0, 0, 0
            else:
                letter, at = audit[at], at + 1
                if letter != "D":
                    if letter == "K":
                        state = _keep(symbol(role, SOUND), state)
                    else:
                        state = _TURN[state]
                        role = names[state]
                    out.append((conv, place, letter, role, text))
                    place += 1
            insert(conv)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(
                (batch.column(0).type, pa.int64(), pa.string(), pa.string(), pa.string()))],
            names=["conv_id", "place", "edit", "role", "text"])


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), edit (K, R or I), role, text.

    ``found`` has the conversations' audits, as :func:`audits` gives them.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = _clean(turns).select("conv_id", "role", "text", F.lit(None).cast("string").alias("audit"), "turn", F.lit(1).alias("after"))
    heads = found.select("conv_id", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit",
                         F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), F.lit(0).alias("after"))
    order = ["conv_id", "after", F.col("turn").asc_nulls_first(), "role", F.md5("text")]
    return (rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order)
            .mapInArrow(_apply, f"conv_id {kind}, {_KEPT}"))


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state, kind = None, None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()])],
                                          names=["conv_id", "repaired_sha256"])

    for batch in batches:
        kind = batch.column(0).type
        for c, place, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if place == 0:
                if state:
                    yield out()
                conv, state = c, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(line.encode("utf-8", "surrogatepass"))
    if state:
        yield out()


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired turns, as ``role:text`` joined by line breaks; nothing is held."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    return (turns.select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "place")
            .mapInArrow(_digest, f"conv_id {kind}, repaired_sha256 string"))
