"""Removal of repeated passages, also those that start and end within a line.

Units are nested: a line, and in it its clauses (up to a word that ends in one
of ``.!?,;:``).  A clause of more than ``LONG`` words is cut further, after words
whose length is a multiple of 8, so texts without marks have units too, which do
not depend on where the clause begins.  Clauses of ``UNIT`` words or more are
normalised (lower case, white space collapsed) and hashed; so is a line of as many
words without such a clause, and a clause that goes on over a line break, as copies
may be wrapped elsewhere.  Digests are grouped over the whole table, and of
equal units the earliest ranked occurrence is the source: the smallest id, then
the first place.

Every other occurrence is a seed: on the diagonal between it and its source, the
texts are compared word by word.  A run is a longest stretch of equal words that
holds a seed of this diagonal.  Runs of ``min_words`` words or more are removed;
so the length is tested on one stretch with one source, and a short clause that
recurs by chance or custom stays.  Spans keep the offsets (code points) of the
original text, and the source of each.

Work: a text sends one short row per unit.  Seeds whose four neighbouring words
differ on both sides can't reach ``min_words`` and go at once.  Seeds are joined
per (document, source, diagonal); only texts that take part are hashed by word, in
rows of ``CHUNK`` words, and a diagonal fetches the rows it needs, with ``ROOM``
words around its seeds.  The few whose runs go on beyond that are asked again with
more room, until none is left.  Hashes of units only lead to comparisons of
64-bit word hashes.  Groups are reduced to their earliest row by a partial
aggregate, so a unit that a third of the documents share needs no task of its own;
the joins with sources are plain ones, whose hot keys the engine splits.

Defined cases: null or empty text has no units; rows of one id and text count as
one document and get the same spans; of texts under one id that differ, the one
with the smaller hash comes first; rows with a null id come after all others, in
the order of a hash of their text; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import _powers, mix, saved, small_batches
from quarry.llm.substring import identity

MIN_WORDS = 20
UNIT, LONG = 4, 24  # words of a unit at least; of a clause that is not cut further at most
CONTEXT = 4  # neighbouring words that a seed is looked at first
CHUNK, ROOM = 32, 32
_WORD = re.compile(r"\S+")
_BREAK, _CUT = np.uint64(1), np.uint64(2)


class Words(dict):
    """word -> 64-bit hash of its lower case; bit 0: it ends a clause, bit 1: a long clause may be cut after it."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass")) & ~3
        value |= (word[-1] in ".!?,;:") | (len(word) % 8 == 0) << 1
        self[word] = value
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def units(text: str, known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a text, starts and ends (in words) of its units."""
    words: list[str] = []
    line_ends = []
    for line in text.split("\n"):
        found = line.split()
        if found:
            words += found
            line_ends.append(len(words))
    a = known.of(words)
    if len(a) < UNIT:
        return a, np.empty(0, np.int64), np.empty(0, np.int64)
    line_ends = np.array(line_ends)
    lengths = np.diff(line_ends, prepend=0)
    marks = (a & _BREAK) > 0
    marks[-1] = True
    over, over_ends = _clauses(marks, a)
    crosses = np.searchsorted(line_ends, over, "right") < np.searchsorted(line_ends, over_ends, "left")
    marks[line_ends - 1] = True
    starts, ends = _clauses(marks, a)
    has = np.bincount(np.searchsorted(line_ends, ends), minlength=len(line_ends)) > 0
    whole = (lengths >= UNIT) & ~has  # lines of short clauses alone
    return (a, np.concatenate([starts, over[crosses], (line_ends - lengths)[whole]]),
            np.concatenate([ends, over_ends[crosses], line_ends[whole]]))


def _clauses(last: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of clauses that end at the words marked, the long ones cut; short ones are left out."""
    stops = np.flatnonzero(last) + 1
    sizes = np.diff(stops, prepend=0)
    if sizes.max() > LONG:
        stops = np.flatnonzero(last | (np.repeat(sizes > LONG, sizes) & ((a & _CUT) > 0))) + 1
        sizes = np.diff(stops, prepend=0)
    good = sizes >= UNIT
    return (stops - sizes)[good], stops[good]


def _digests(a: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of every run a[start:stop] of word hashes."""
    up, down = _powers(1 << max(16, len(a).bit_length()))
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(mix(a) * up[: len(a)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


_UNITS = "node long, text_key long, at int, n int, d long, before int, after int"


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = Words()
    for batch in small_batches(batches, "text", 2 << 20):
        out: list[list[np.ndarray]] = [[] for _ in range(7)]
        for k, text in enumerate(batch.column(2).to_pylist()):
            a, starts, stops = units(text or "", known)
            if not len(starts):
                continue
            far = np.maximum(starts - CONTEXT, 0), np.minimum(stops + CONTEXT, len(a))
            near = (_digests(a, far[0], starts), _digests(a, stops, far[1]))
            lacks = (starts < CONTEXT, stops + CONTEXT > len(a))
            cols = (np.full(len(starts), k), starts, stops - starts, _digests(a, starts, stops),
                    *(np.where(no, 0, (h >> np.uint64(34)) + np.uint64(1)) for h, no in zip(near, lacks)))
            for held, col in zip(out, cols):
                held.append(col)
        if out[0]:
            row, at, n, d, before, after = (np.concatenate(c) for c in out[:6])
            context = [pa.array(c.astype(np.int32), mask=c == 0) for c in (before, after)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(at.astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(d.view(np.int64)), *context],
                names=["node", "text_key", "at", "n", "d", "before", "after"])


def _diagonals(found: DataFrame, min_words: int) -> DataFrame:
    """(req, node, text_key, a_node, a_key, off, seeds): seeds of a document that share source and diagonal."""
    earliest = F.min(F.struct("node", "text_key", "at", "before", "after"))
    first = saved(found.groupBy("d").agg(earliest.alias("a"), F.count(F.lit(1)).alias("times")).where("times > 1").select(
        "d", F.col("a.node").alias("a_node"), F.col("a.text_key").alias("a_key"), F.col("a.at").alias("a_at"),
        F.col("a.before").alias("a_before"), F.col("a.after").alias("a_after")), "sources")
    reach = F.expr(f"n > {min_words - 2 * CONTEXT} OR coalesce(before = a_before, false) OR coalesce(after = a_after, false)")
    seeds = found.join(first, "d").where(~F.expr("node = a_node AND text_key = a_key AND at = a_at") & reach)
    return saved(seeds.groupBy("node", "text_key", "a_node", "a_key", (F.col("a_at") - F.col("at")).alias("off"))
                 .agg(F.array_sort(F.collect_set(F.struct("at", "n"))).alias("seeds"))
                 .withColumn("req", F.monotonically_increasing_id()), "diagonals")


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = Words()
    for batch in small_batches(batches, "text", 2 << 20):
        row, at, parts = [], [], []
        for k, text in enumerate(batch.column(2).to_pylist()):
            a = known.of((text or "").split())
            row.append(np.full(-(-len(a) // CHUNK), k))
            at.append(np.arange(-(-len(a) // CHUNK)))
            parts.append((a, len(a)))
        sizes = [np.append(np.full(n // CHUNK, CHUNK), [n % CHUNK] if n % CHUNK else []) for _, n in parts]
        stops = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        words = np.concatenate([a for a, _ in parts]).view(np.int64)
        take = pa.array(np.concatenate(row).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(at).astype(np.int32)),
             pa.ListArray.from_arrays(pa.array(stops), pa.array(words))], names=["node", "text_key", "chunk", "words"])


def runs_of(b: np.ndarray, a: np.ndarray, b_at: int, a_at: int, off: int, seeds: np.ndarray, room: int,
            min_words: int) -> tuple[list[tuple[int, int]], bool]:
    """Runs (start, stop) in words of b, whose word i meets word i + off of a; whether one may go on beyond the words given.

    ``b`` holds the words from ``b_at`` on, ``a`` those from ``a_at`` on.
    """
    low, high = max(b_at, a_at - off), min(b_at + len(b), a_at - off + len(a))
    same = np.zeros(high - low + 2, np.int8)
    same[1:-1] = b[low - b_at : high - b_at] == a[low + off - a_at : high + off - a_at]
    turn = np.diff(same)
    starts, stops = np.flatnonzero(turn == 1) + low, np.flatnonzero(turn == -1) + low
    k = np.searchsorted(starts, seeds[:, 0], side="right") - 1  # the stretch that each seed lies in
    inside = np.unique(k[(k >= 0) & (seeds[:, 0] + seeds[:, 1] <= stops[np.maximum(k, 0)])]) if len(starts) else []
    out, more = [], False
    for s, e in ((int(starts[i]), int(stops[i])) for i in inside):
        more |= (s == low and low > 0 and low + off > 0) or (e == high and high >= int((seeds[:, 0] + seeds[:, 1]).max()) + room)
        if e - s >= min_words:
            out.append((s, e))
    return out, more


def _runs(batches: Iterable[pa.RecordBatch], room: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """Rows (req, side, at, words) in order -> runs; side 0 holds seeds (at: the diagonal), 1 the words of b, 2 those of a."""
    req, sides = None, {}

    def found() -> list[tuple]:
        if set(sides) != {0, 1, 2}:  # text that changed between two reads
            return []
        off, seeds = sides[0][0][0], sides[0][0][1].reshape(-1, 2)
        b, a = (np.concatenate([w for _, w in sides[s]]) for s in (1, 2))
        runs, more = runs_of(b, a, sides[1][0][0], sides[2][0][0], off, seeds, room, min_words)
        return [(req, True, 0, 0)] if more else [(req, False, s, e) for s, e in runs]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.bool_(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                          names=["req", "more", "start", "stop"])

    for batch in batches:
        rows = []
        stops = batch.column(3).offsets.to_numpy()
        words = batch.column(3).flatten().to_numpy()
        for k, (r, side, at) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)))):
            if r != req:
                rows += found() if sides else []
                req, sides = r, {}
            sides.setdefault(side, []).append((at, words[stops[k] - stops[0] : stops[k + 1] - stops[0]]))
        yield batch_of(rows)
    if sides:
        yield batch_of(found())


def _compared(asked: DataFrame, chunks: DataFrame, room: int, min_words: int) -> DataFrame:
    low = F.greatest(F.lit(0), F.col("seeds")[0]["at"] - room)
    last = F.aggregate("seeds", F.lit(0), lambda m, s: F.greatest(m, s["at"] + s["n"])) + room
    ranged = asked.withColumns({"low": low, "high": last})
    b = ranged.select("req", F.lit(1).alias("side"), "node", "text_key", "low", "high")
    a = ranged.select("req", F.lit(2).alias("side"), F.col("a_node").alias("node"), F.col("a_key").alias("text_key"),
                      F.greatest(F.lit(0), F.col("low") + F.col("off")).alias("low"), (F.col("high") + F.col("off")).alias("high"))
    each = F.explode(F.sequence(F.expr(f"int(low div {CHUNK})"), F.expr(f"int((high - 1) div {CHUNK})"))).alias("chunk")
    parts = b.unionByName(a).select("req", "side", "node", "text_key", each).join(chunks, ["node", "text_key", "chunk"])
    rows = parts.select("req", "side", (F.col("chunk") * CHUNK).alias("at"), "words")
    flat = F.flatten(F.transform("seeds", lambda s: F.array(s["at"].cast("long"), s["n"].cast("long"))))
    heads = asked.select("req", F.lit(0).alias("side"), F.col("off").alias("at"), flat.alias("words"))
    return saved(rows.unionByName(heads).repartition("req").sortWithinPartitions("req", "side", "at")
                 .mapInArrow(partial(_runs, room=room, min_words=min_words), "req long, more boolean, start int, stop int"), "runs")


def _spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their runs -> disjoint spans in code points."""
    for batch in batches:
        out = []
        for node, key, text, runs in zip(*(batch.column(i).to_pylist() for i in range(4))):
            places = [m.span() for m in _WORD.finditer(text)]
            at = number = 0
            for run in sorted(runs, key=lambda r: (r["start"], -r["stop"], r["a_node"])):
                start = max(at, run["start"])
                if start < run["stop"]:
                    first, last = places[start][0], places[run["stop"] - 1][1]
                    out.append((node, key, number, first, last - first, run["stop"] - start, run["a_node"]))
                    at, number = run["stop"], number + 1
        kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                         names=["node", "text_key", "unit", "start", "length", "words", "first_node"])


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed span: node, text_key, unit (its number in the text), start, length, words, first_node.

    Spans of a text are disjoint: where runs of several sources overlap, the later
    one begins after the earlier one.  ``substring.remove_spans`` removes them.
    """
    if min_words < UNIT:
        raise ValueError(f"passages have {UNIT} words at least; repeated_spans takes any line")
    named = docs.select(*identity(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    asked = _diagonals(saved(named.mapInArrow(_units, _UNITS), "units"), min_words)
    ends = asked.select("node", "text_key").unionByName(
        asked.select(F.col("a_node").alias("node"), F.col("a_key").alias("text_key"))).distinct()
    chunks = saved(named.dropDuplicates(["node", "text_key"]).join(ends, ["node", "text_key"], "left_semi")
                   .mapInArrow(_chunks, "node long, text_key long, chunk int, words array<long>"), "word_rows")
    room, found, todo = ROOM, [], asked
    while True:
        runs = _compared(todo, chunks, room, min_words)
        found.append(runs.where("NOT more"))
        again = runs.where("more").select("req")
        if not again.head(1):
            break
        todo, room = asked.join(again, "req"), room * 16
    runs = found[0]
    for part in found[1:]:
        runs = runs.unionByName(part)
    per_text = runs.join(asked.select("req", "node", "text_key", "a_node"), "req").groupBy("node", "text_key").agg(
        F.collect_set(F.struct("start", "stop", "a_node")).alias("runs"))  # at most one per unit of the text
    spans = named.join(per_text, ["node", "text_key"]).select("node", "text_key", "text", "runs").mapInArrow(
        _spans, "node long, text_key long, unit int, start int, length int, words int, first_node long")
    return spans.dropDuplicates(["node", "text_key", "unit"])
