"""Exact substring deduplication by longest-previous-factor arrays.

Texts are UTF-8 bytes; matches never cross documents.  A byte is repeated if a
string of ``length`` bytes that covers it also starts elsewhere.

1. Anchors.  Every window of ``length`` bytes names the place of its smallest
   50-byte hash.  Equal windows name the same place in them, so they share the
   anchor's hash and lie at the same distance from it.  The windows of one anchor
   form a run.
2. Runs.  Runs with the same bytes are counted; all windows of such a run are
   repeated.  Anchors with one run only need nothing more.
3. Suffix arrays.  The remaining runs meet the other runs of their anchor hash:
   one copy of each goes to a task, which sorts the suffixes of its runs by prefix
   doubling up to ``length`` bytes and finds each suffix's previous and next
   smaller position in suffix order.  The larger of the two common prefixes is
   the longest previous factor: a match of ``length`` bytes that starts earlier.
   The same with larger positions gives later matches.  Only factors of ``length``
   bytes remove anything, so here the array is asked whether a factor reaches
   that (equal rank at this depth), not how long a shorter one is.

``keep="none"`` removes every repeated byte, ``keep="first"`` only those with an
earlier match (documents in order of id), so the first copy stays.

Skew: copies are counted, not collected.  An anchor hash with more than ``MOST``
different runs is split by the windows' distance from the anchor and the bytes
that all windows of that part share; windows that are equal stay together.  The
parts get smaller until a part is one window, which needs no suffix array.  The counts of
such hashes are a table of their own, which Spark broadcasts while it is small, so
their runs are not dealt by the hash alone to get them.

Defined cases: null text is empty; texts below ``length`` bytes keep everything;
repeated rows are copies of each other; null ids come after all others, in the
order of a hash of their text; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import prefix_hashes, saved, small_batches, utf8

NO_ID = 1 << 62
ANCHOR = 50
MOST = 512  # different runs of one anchor hash that may meet in a task
CHUNK = 1 << 20  # bytes of runs in one suffix array
SEGMENT = 1 << 19  # windows of a text looked at at once
_RUN = ("node long, text_key long, key1 long, key2 long, u1 long, u2 long, at long, s1 long, s2 long")
_RUN_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in _RUN.split(", ")])


def anchors(data: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, first window, last window, anchor hash) of every run of windows."""
    width = length - ANCHOR + 1
    for base in range(0, len(data) - length + 1, SEGMENT):
        part = data[base : base + SEGMENT + length - 1]
        grams = prefix_hashes(part, ANCHOR)
        windows = len(part) - length + 1
        # the top bits of the hash, then the place: the smallest is the leftmost of the smallest hashes
        ranked = (grams >> np.uint64(20) << np.uint64(20)) | np.arange(len(grams), dtype=np.uint64)
        padded = np.full(-(-len(ranked) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[: len(ranked)] = ranked
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
        place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut, [windows]]) - 1
        at = place[first]
        yield from zip((base + at).tolist(), (base + first).tolist(), (base + last).tolist(), grams[at].view(np.int64).tolist())


def _pair(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def _runs(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", 4 << 20):
        rows, digests = [], []
        for node, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
            for at, first, last, anchor in anchors(np.frombuffer(text, np.uint8), length) if len(text) >= length else ():
                digests.append(xxhash.xxh3_128_digest(text[first : last + length]))
                rows.append((node, key, anchor, at, first, last))
        if rows:
            node, key, anchor, at, first, last = zip(*rows)
            u = _pair(digests)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (node, key, anchor, [0] * len(rows), u[:, 0], u[:, 1], at, first, last)],
                schema=_RUN_ARROW)


_CUT = ("key1 long, key2 long, node long, text_key long, at long, s1 long, s2 long, copies long, kinds long, bytes binary")
_CUT_ARROW = pa.schema([(f.split()[0], pa.binary() if f.endswith("binary") else pa.int64()) for f in _CUT.split(", ")])
_PART = ("key1 long, key2 long, node long, text_key long, at long, s1 long, s2 long, u1 long, u2 long, "
         "run1 long, run2 long, run_s1 long")
_PART_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in _PART.split(", ")])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _parts(batches: Iterable[pa.RecordBatch], length: int, width: int) -> Iterator[pa.RecordBatch]:
    """Runs cut into parts of ``width`` distances, keyed by anchor, part and the bytes that its windows share."""
    for batch in batches:
        rows = []
        for key1, key2, node, text_key, at, s1, s2, _, _, data in zip(*(c.to_pylist() for c in batch.columns)):
            for part in range((at - s2) // width, (at - s1) // width + 1):
                near, far = part * width, part * width + width - 1
                first, last = max(s1, at - far), min(s2, at - near)
                shared = data[at - near - s1 : at - far + length - s1]
                key, u = _pair([xxhash.xxh3_128_digest(b"%d %d %d " % (key1, key2, part) + shared),
                                xxhash.xxh3_128_digest(data[first - s1 : last + length - s1])]).tolist()
                rows.append((*key, node, text_key, at, first, last, *u, key1, key2, s1))
        if rows:
            yield _table(rows, _PART_ARROW)


def _cut_out(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of runs, from their texts."""
    for batch in batches:
        rows = []
        for node, key, text, runs in zip(*(batch.column(i).to_pylist() for i in range(4))):
            rows += [(r["key1"], r["key2"], node, key, r["at"], r["s1"], r["s2"], r["copies"], r["kinds"],
                      text[r["s1"] : r["s2"] + length]) for r in runs]
        if rows:
            yield _table(rows, _CUT_ARROW)


class SuffixOrder:
    """Suffixes of several byte strings in order of their first ``length`` bytes."""

    def __init__(self, strings: list[bytes], length: int):
        joined = np.frombuffer(b"".join(s + bytes(8) for s in strings) + bytes(length), np.uint8)
        n = len(joined) - length
        sizes = np.array([len(s) for s in strings])
        self.start = np.cumsum(sizes + 8) - sizes - 8
        # places where a whole window begins, in text order
        self.position = np.concatenate([np.arange(a, a + m - length + 1) for a, m in zip(self.start.tolist(), sizes.tolist())])
        word = np.zeros(n, np.uint64)
        for k in range(8):
            word = (word << np.uint64(8)) | joined[k : k + n]
        self.levels: list[tuple[int, np.ndarray]] = []
        step, rank = 8, self._dense(word)
        while step * 3 <= length:  # triples: ranks of 21 bits fit one word
            self.levels.append((step, rank))
            rank, step = self._join(rank, (step, 2 * step)), step * 3
        self.levels.append((step, rank))
        if step < length:
            rank = self._join(rank, (length - step,) if length <= 2 * step else (step, length - step))
        self.length, self.joined, self.rank = length, joined, rank
        self.order = np.argsort(rank[self.position], kind="stable")  # suffix order: numbers into position

    @staticmethod
    def _dense(values: np.ndarray) -> np.ndarray:
        return np.unique(values, return_inverse=True)[1].astype(np.uint64)

    def _join(self, rank: np.ndarray, shifts: tuple[int, ...]) -> np.ndarray:
        """Ranks of longer prefixes: each place's rank, then those at the shifts after it."""
        bits = np.uint64(max(1, int(len(rank)).bit_length()))
        assert bits * np.uint64(len(shifts) + 1) <= 64, "a chunk holds at most two million bytes"
        value = rank
        for shift in shifts:
            after = np.zeros(len(rank), np.uint64)
            after[: max(0, len(rank) - shift)] = rank[shift:]
            value = (value << bits) | after
        return self._dense(value)

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix, at most ``length``, of the suffixes at places a and b."""
        out = np.zeros(len(a), np.int64)
        for step, rank in [x for level in self.levels[::-1] for x in (level, level)]:
            x, y = np.minimum(a + out, len(rank) - 1), np.minimum(b + out, len(rank) - 1)
            out += np.where((rank[x] == rank[y]) & (out + step <= self.length), step, 0)
        for _ in range(8):
            x, y = np.minimum(a + out, len(self.joined) - 1), np.minimum(b + out, len(self.joined) - 1)
            out += (self.joined[x] == self.joined[y]) & (out < self.length)
        return np.where(self.rank[a] == self.rank[b], self.length, np.minimum(out, self.length - 1))


def _previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each one (-1: none), by jumping from candidate to candidate."""
    found = np.arange(len(values)) - 1
    todo = np.arange(1, len(values))
    while len(todo):
        todo = todo[(found[todo] >= 0) & (values[found[todo]] > values[todo])]
        found[todo] = found[found[todo]]
        todo = todo[found[todo] >= 0]
    return found


def longest_previous_factor(order: SuffixOrder, later: bool = False, whole: bool = False) -> np.ndarray:
    """For every window start, in text order: the longest match (at most ``length``) that starts earlier, or later.

    ``whole`` gives 0 for matches shorter than ``length``, whose extent then need not be found.
    """
    at = order.order
    n = len(at)
    text_order = -at if later else at
    before = _previous_smaller(text_order)
    after = n - 1 - _previous_smaller(text_order[::-1])[::-1]
    best = np.zeros(n, np.int64)
    place = order.position[at]
    for other, real in ((before, before >= 0), (after, after < n)):
        rows = np.flatnonzero(real)
        mine, theirs = place[rows], place[other[rows]]
        common = (np.where(order.rank[mine] == order.rank[theirs], order.length, 0) if whole
                  else order.common_prefix(mine, theirs))
        best[rows] = np.maximum(best[rows], common)
    out = np.empty(n, np.int64)
    out[at] = best
    return out


def repeated_windows(strings: list[bytes], length: int, keep: str) -> list[np.ndarray]:
    """For each string (in document order): the starts of its windows that match elsewhere (or earlier)."""
    order = SuffixOrder(strings, length)
    factor = longest_previous_factor(order, whole=True)
    if keep == "none":
        factor = np.maximum(factor, longest_previous_factor(order, later=True, whole=True))
    hit = order.position[factor >= length]
    bounds = np.searchsorted(hit, [*order.start.tolist(), 1 << 60])
    return [hit[bounds[k] : bounds[k + 1]] - order.start[k] for k in range(len(strings))]


def _match(batches: Iterable[pa.RecordBatch], length: int, keep: str) -> Iterator[pa.RecordBatch]:
    """Covered spans of the runs of a task, which come sorted by key."""
    held: list[tuple] = []
    size = 0

    def covered() -> pa.RecordBatch:
        rows = []
        runs = sorted(held, key=lambda r: (r[2], r[3], r[5]))  # in document order
        for run, starts in zip(runs, repeated_windows([r[9] for r in runs], length, keep)):
            if (run[7] > 1 and keep == "none") or not len(starts):
                continue  # all copies of the run are covered already
            cut = np.flatnonzero(np.diff(starts) > 1) + 1
            for group in np.split(starts, cut):
                rows.append((run[2], run[3], run[5] + int(group[0]), run[5] + int(group[-1]) + length))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                                          names=["node", "text_key", "lo", "hi"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= CHUNK and row[:2] != held[-1][:2]:
                yield covered()
                held, size = [], 0
            held.append(row)
            size += len(row[9])
    if held:
        yield covered()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(text)
    node: Column = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID) + F.shiftrightunsigned(key, 2))
    return docs.select(node.alias("node"), key.alias("text_key"), text.cast("binary").alias("text"))


def _with_text(rows: DataFrame, runs: DataFrame, columns: list[str]) -> DataFrame:
    """(node, text_key, text, runs): the texts of the given runs; equal rows once."""
    per_text = runs.select("node", "text_key", *columns).distinct().groupBy("node", "text_key").agg(
        F.collect_list(F.struct(*columns)).alias("runs"))  # repeated rows have the same runs
    return rows.join(per_text, ["node", "text_key"]).dropDuplicates(["node", "text_key"]).select("node", "text_key", "text", "runs")


def covered_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                  keep: str = "none") -> DataFrame:
    """(node, text_key, lo, hi): byte spans to remove; they may overlap."""
    rows = _rows(docs, id_col, text_col)
    live, same, spans = _counted(saved(rows.mapInArrow(partial(_runs, length=length), _RUN), "runs"), length, keep)
    several = _one_of_each(live, same)
    cut = saved(_with_text(rows, several, [*_KEY, "at", "s1", "s2", "copies", "kinds"]).mapInArrow(
        partial(_cut_out, length=length), _CUT), "run_bytes")
    spans = spans.unionByName(_matched(cut, length, keep))
    for width in (44, 6, 1):
        hot = cut.where(F.col("kinds") > MOST)
        if hot.isEmpty():
            break
        live, same, found = _counted(saved(hot.mapInArrow(partial(_parts, length=length, width=width), _PART), "run_parts"),
                                     length, keep)
        spans = spans.unionByName(found)
        of_run = hot.select(F.col("key1").alias("run1"), F.col("key2").alias("run2"), "node", "text_key",
                            F.col("s1").alias("run_s1"), "bytes")
        start = (F.col("s1") - F.col("run_s1") + 1).cast("int")
        part = F.substring(F.col("bytes"), start, (F.col("s2") - F.col("s1") + length).cast("int"))
        cut = saved(_one_of_each(live, same).join(of_run, ["run1", "run2", "node", "text_key", "run_s1"])
                    .withColumn("bytes", part).select(*_CUT_ARROW.names), "part_bytes")
        spans = spans.unionByName(_matched(cut, length, keep))
    return spans


_KEY = ["key1", "key2"]


def _counted(runs: DataFrame, length: int, keep: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(runs whose key occurs again, counts of their different bytes, spans of the runs that are copies)."""
    often = saved(runs.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*_KEY), "repeated_keys")
    live = saved(runs.join(often, _KEY, "left_semi"), "live_runs")
    same = live.groupBy(*_KEY, "u1", "u2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("node", "text_key", "s1")).alias("one"))
    same = saved(same, "run_copies")
    kinds = saved(same.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("kinds")), "run_kinds")
    # the few keys with many runs are a small table of their own, so that these runs do not meet in one task to get their count
    many = saved(kinds.where(F.col("kinds") > MOST), "many_kinds")
    rest = same.join(many, _KEY, "left_anti").join(kinds.where(F.col("kinds") <= MOST), _KEY)
    same = saved(same.join(many, _KEY).unionByName(rest), "run_counts")
    copied = live.join(same.where("copies > 1").select(*_KEY, "u1", "u2", "one"), [*_KEY, "u1", "u2"])
    if keep == "first":
        copied = copied.where(F.struct("node", "text_key", "s1") != F.col("one"))
    return live, same, copied.select("node", "text_key", F.col("s1").alias("lo"), (F.col("s2") + length).alias("hi"))


def _one_of_each(live: DataFrame, same: DataFrame) -> DataFrame:
    """The first copy of every run whose key has other runs too."""
    mixed = same.where("kinds > 1").select(*_KEY, "u1", "u2", "one", "copies", "kinds")
    return live.join(mixed, [*_KEY, "u1", "u2"]).where(F.struct("node", "text_key", "s1") == F.col("one"))


def _matched(cut: DataFrame, length: int, keep: str) -> DataFrame:
    """Spans found by the suffix arrays of the keys with few different runs."""
    few = cut.where(F.col("kinds") <= MOST)
    tasks = (few.agg(F.sum(F.length("bytes"))).first()[0] or 0) // (8 * CHUNK) + 1
    tasks = max(tasks, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return saved(few.repartition(tasks, *_KEY).sortWithinPartitions(*_KEY).mapInArrow(
        partial(_match, length=length, keep=keep), "node long, text_key long, lo long, hi long"), "spans")


def _merged(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
            gone = _merged(spans or [])
            ends = [0, *(hi for _, hi in gone)]
            starts = [*(lo for lo, _ in gone), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(ends, starts))
            rows.append((doc, len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept,
                         [{"lo": lo, "hi": hi} for lo, hi in gone]))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                     pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                keep: str = "none") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans) for every row; ``kept`` are the bytes left.

    Spans are byte offsets of the original text.  Kept bytes may break a code
    point at a span's edge, so they stay bytes.
    """
    spans = covered_spans(docs, id_col=id_col, text_col=text_col, length=length, keep=keep)
    per_text = spans.distinct().groupBy("node", "text_key").agg(
        F.collect_list(F.struct("lo", "hi")).alias("spans"))  # repeated rows share their spans; summed before the shuffle
    joined = _rows(docs, id_col, text_col).join(per_text, ["node", "text_key"], "left")
    return joined.select(F.when(F.col("node") < NO_ID, F.col("node")).alias("doc_id"), "text", "spans").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
                 "spans array<struct<lo:long,hi:long>>")
