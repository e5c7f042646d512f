"""Benchmark decontamination by SimHash windows, multi-index Hamming search and verification.

Every benchmark item (words lower-cased) gets a SimHash fingerprint of 256 bits
over its 5-word shingles, each bit sum weighted by the root of the weights.  A document's windows of the item's size get
fingerprints the same way, by prefix sums over the text.  The fingerprint is cut
into 32 blocks of 8 bits: two fingerprints within the radius of 63 bits agree to
within one bit in at least one block (63 = 32 * 2 - 1), so an index from every
block value and its one-bit neighbours to items finds all items within the
radius.  Candidates are verified by the exact weighted Jaccard similarity of the
two shingle multisets; windows at or above the threshold are reported, the best
one per document and item.

At similarity 0.8 the expected distance is 38 bits with a deviation of 6, so for
even weights the radius misses a window with a chance below 1e-4.  The angle of
two sets depends on squared bit weights, so the roots make it depend on the
weights that the similarity has.  With 150 shingles that all of 1,000 items hold
and 5 own ones, two of them changed (similarity 0.846), 0 of 500 trials missed
the window (mean distance 33 bits); with plain weights 15% did.  A window that shares no
shingle with the item has similarity 0; windows are therefore fingerprinted only
for items of which the text holds a shingle, around those places.

A shingle's weight is ``1 + ln(items / items that hold it)``; the weights depend
on the benchmark alone.  The benchmark is the query set: it is broadcast to the
tasks, and ``MOST_ITEMS`` bounds one round's share of it.  A larger one is
searched in several rounds over the documents, so no item is left out; the
shingles are then counted once over the whole benchmark, and every round gets
the counts of those of its own that several items hold (any other has the top
weight), so the result does not depend on the number of rounds.  The index is made
once per worker process and consists of sorted arrays: block values are looked up
in postings of the items that share a shingle with the text.

Defined cases: null or empty texts and items match nothing; items with fewer
than 5 words are one shingle of all their words; repeated rows are reported each;
a null item id is reported as null; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import GOLDEN, WordHashes, mix, saved, shingle_hashes, small_batches, utf8

MOST_ITEMS = 20_000  # items searched in one round over the documents
BITS, BLOCKS, RADIUS = 256, 32, 63
_STRETCH = 1024  # windows fingerprinted at once
_HITS = ("doc_id long, text_key string, item_id long, similarity double, start_word long, n_words long")
_ARROW = pa.schema([("doc_id", pa.int64()), ("text_key", pa.string()), ("item_id", pa.int64()),
                    ("similarity", pa.float64()), ("start_word", pa.int64()), ("n_words", pa.int64())])


def bit_signs(shingles: np.ndarray) -> np.ndarray:
    """(n x BITS) signs +1/-1 drawn from each shingle's hash."""
    words = np.stack([mix(shingles + np.uint64(int(GOLDEN) * (k + 1) % 2**64)) for k in range(BITS // 64)], axis=1)
    bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(shingles), -1), axis=1)
    return bits.astype(np.float32) * 2 - 1


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """Bit sums (n x BITS) -> packed fingerprints (n x BLOCKS bytes)."""
    return np.packbits(sums > 0, axis=1)


class Index:
    """Items by size with weights and fingerprints, as sorted arrays.

    ``key`` holds the distinct shingles of all items (with their length in words
    mixed in, as they are hashed), ``weight`` their weights; per item its shingles
    (as numbers of ``key``) with counts, per shingle its items.
    """

    def __init__(self, items: list[tuple], size: int, known: WordHashes, shared: tuple | None = None):
        """``shared``: (items of the whole benchmark, shingles here that several of its items hold, their counts); None: all are here."""
        self.size = size
        texts = [(item_id, known.of((text or "").encode("utf-8", "surrogatepass").lower().split())) for item_id, text in items]
        texts = [(i, w) for i, w in texts if len(w)]
        self.ids = [i for i, _ in texts]
        self.words = [len(w) for _, w in texts]
        runs = [shingle_hashes(w, min(size, len(w))) for _, w in texts]
        bags = [np.unique(r, return_counts=True) for r in runs]
        self.stop = np.cumsum([0, *(len(b) for b, _ in bags)])
        flat = np.concatenate([b for b, _ in bags]) if bags else np.empty(0, np.uint64)
        self.key, at, held = np.unique(flat, return_inverse=True, return_counts=True)
        self.shingle = at.astype(np.int32)  # rising within an item
        self.count = np.concatenate([n for _, n in bags]).astype(np.int32) if bags else np.empty(0, np.int32)
        n_all = len(texts) if shared is None else shared[0]
        if shared is not None:
            held = np.ones(len(self.key), np.int64)
            held[np.searchsorted(self.key, shared[1])] = shared[2]
        self.top = 1 + math.log(max(1, n_all))  # of a shingle that at most one item holds
        self.weight = 1 + np.log(max(1, n_all) / held)
        self.total = [float((self.weight[self.shingle[a:b]] * self.count[a:b]).sum()) for a, b in zip(self.stop, self.stop[1:])]
        order = np.argsort(self.shingle, kind="stable")
        self.item = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.stop))[order]  # by shingle
        self.item_stop = np.searchsorted(self.shingle[order], np.arange(len(self.key) + 1))
        self.grams = np.array([min(size, n) for n in self.words], np.int64)
        self.lengths = sorted(set(self.grams.tolist()))
        self.prints = np.concatenate([fingerprint((bit_signs(r) * np.sqrt(self.weights(r))[:, None]).sum(axis=0)[None]) for r in runs]) \
            if runs else np.empty((0, BLOCKS), np.uint8)

    def numbers(self, shingles: np.ndarray) -> np.ndarray:
        """The numbers of shingles, -1 for those of no item."""
        if not len(self.key):
            return np.full(len(shingles), -1)
        at = np.minimum(np.searchsorted(self.key, shingles), len(self.key) - 1)
        return np.where(self.key[at] == shingles, at, -1)

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        at = self.numbers(shingles)
        return np.where(at >= 0, self.weight[at] if len(self.key) else 0, self.top).astype(np.float32)

    def postings(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (block, value) of the items' blocks and their one-bit neighbours, and the item of each."""
        near = np.array([0, *(1 << b for b in range(8))], np.int64)
        keys = (np.arange(BLOCKS)[:, None] * 256 + (self.prints[items].astype(np.int64)[:, :, None] ^ near)).ravel()
        order = np.argsort(keys, kind="stable")
        return keys[order], np.repeat(items, BLOCKS * len(near))[order]

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted Jaccard of the item's and a window's shingle multisets."""
        found, n = np.unique(window, return_counts=True)
        at = self.numbers(found)
        both = float((n * np.where(at >= 0, self.weight[at], self.top)).sum())
        a, b = self.stop[item], self.stop[item + 1]
        own = self.shingle[a:b]
        place = np.minimum(np.searchsorted(own, at), len(own) - 1)
        mine = np.flatnonzero(own[place] == at)
        common = float((np.minimum(n[mine], self.count[a:b][place[mine]]) * self.weight[at[mine]]).sum())
        return round(common / (both + self.total[item] - common), 9)


def candidates(prints: np.ndarray, keys: np.ndarray, items: np.ndarray) -> Iterator[tuple[int, int]]:
    """(window, item) of all pairs that agree to within one bit in a block: a lookup of every block value in the postings."""
    asked = (np.arange(BLOCKS) * 256 + prints).ravel()
    lo, hi = np.searchsorted(keys, asked, "left"), np.searchsorted(keys, asked, "right")
    hits = np.flatnonzero(hi > lo)
    if len(hits):
        n = hi[hits] - lo[hits]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[hits], n)
        pairs = np.unique(np.repeat(hits // BLOCKS, n) << 32 | items[at])
        yield from zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist())


def _stretches(hits: np.ndarray, window: int, last: int) -> Iterator[tuple[int, int]]:
    """Ranges [lo, hi) of window starts that hold one of the hit places."""
    lo = hi = -1
    for h in hits.tolist():
        a, b = max(0, h - window + 1), min(h, last) + 1
        if a >= b:
            continue
        if a > hi:
            if hi > lo:
                yield lo, hi
            lo = a
        hi = b
    if hi > lo:
        yield lo, hi


def matches(words: np.ndarray, index: Index, threshold: float) -> Iterator[tuple]:
    """(item number, similarity, first word) of the best window of every matching item."""
    for n in index.lengths:
        shingles = shingle_hashes(words, n)
        if not len(shingles):
            continue
        number = index.numbers(shingles)
        places = np.flatnonzero(number >= 0)
        if not len(places):
            continue
        of_item = defaultdict(list)
        for p in places.tolist():
            k = number[p]
            for item in index.item[index.item_stop[k] : index.item_stop[k + 1]].tolist():
                if index.grams[item] == n:
                    of_item[item].append(p)
        by_window = defaultdict(list)  # windows of one size are fingerprinted once
        for k, hits in of_item.items():
            by_window[index.words[k] - n + 1].append(k)
        for window, items in by_window.items():
            window_at = min(window, len(shingles))  # a text shorter than the item is one window
            hits = np.unique(np.concatenate([of_item[k] for k in items]))
            best: dict[int, tuple] = {}
            keys, of_key = index.postings(np.array(items))
            for lo, hi in _stretches(hits, window_at, len(shingles) - window_at):
                for a in range(lo, hi, _STRETCH):
                    b = min(hi, a + _STRETCH)
                    part = shingles[a : b + window_at - 1]
                    sums = np.zeros((len(part) + 1, BITS), np.float32)
                    np.cumsum(bit_signs(part) * np.sqrt(index.weights(part))[:, None], axis=0, out=sums[1:])
                    prints = fingerprint(sums[window_at:] - sums[:-window_at])
                    for w, k in candidates(prints, keys, of_key):
                        if int(np.bitwise_count(prints[w] ^ index.prints[k]).sum()) <= RADIUS:
                            s = index.similarity(k, shingles[a + w : a + w + window_at])
                            if s >= threshold and s > best.get(k, (0.0, 0))[0]:
                                best[k] = (s, int(a + w))
            yield from ((k, s, at_word) for k, (s, at_word) in best.items())


def _item_shingles(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The distinct shingles of every item, and a null for every item with a word."""
    known = WordHashes()
    for batch in small_batches(batches, "text"):
        for text in utf8(batch.column(0)):
            words = known.of(text.lower().split())
            if len(words):
                own = np.unique(shingle_hashes(words, min(size, len(words)))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([None, *own.tolist()], pa.int64())], names=["shingle"])


def _held(items: DataFrame, size: int) -> DataFrame:
    """(shingle, n): by how many items it is held, for those of several; a null shingle counts the items with a word."""
    return saved(items.select("text").mapInArrow(partial(_item_shingles, size=size), "shingle long")
                 .groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("shingle IS NULL OR n > 1"), "item_shingles")


def _shared(held: DataFrame, part: DataFrame, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(items of the benchmark, the round's shingles that several hold, their counts): bounded by the round's items."""
    total = held.where("shingle IS NULL").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    own = part.select("text").mapInArrow(partial(_item_shingles, size=size), "shingle long").where("shingle IS NOT NULL").distinct()
    rows = held.join(own, "shingle", "left_semi").collect()
    keys, n = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    return total, keys.view(np.uint64), n


_INDEXES: dict[str, Index] = {}


def _index(name: str, items: list[tuple], size: int, shared: tuple | None) -> Index:
    """The round's index, made once in a worker process; the one of an earlier round goes."""
    if name not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[name] = Index(items, size, WordHashes(), shared)
    return _INDEXES[name]


def _search(batches: Iterable[pa.RecordBatch], name: str, items: list[tuple], size: int, threshold: float,
            shared: tuple | None = None) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    index = _index(name, items, size, shared)
    for batch in small_batches(batches, "text"):
        rows = []
        for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), utf8(batch.column(1))):
            words = known.of(text.lower().split())
            for k, s, at in matches(words, index, threshold):
                rows.append((doc, key, index.ids[k], s, at, index.words[k]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _ARROW)], schema=_ARROW)


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 size: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, text_key, item_id, similarity, start_word, n_words): the best window per document and item.

    ``text_key`` is the md5 of the document's text.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_key"))
    chosen = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    rounds = max(1, -(-chosen.count() // MOST_ITEMS))
    held = None if rounds == 1 else _held(chosen, size)  # one table of counts for all rounds
    found = None
    for k in range(rounds):
        part = chosen if rounds == 1 else chosen.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == k)
        items = [(r[0], r[1]) for r in part.collect()]  # the query set, MOST_ITEMS on average
        shared = None if held is None else _shared(held, part, size)
        hits = plain.mapInArrow(partial(_search, name=uuid.uuid4().hex, items=items, size=size, threshold=threshold, shared=shared), _HITS)
        found = hits if found is None else found.unionByName(hits)
    return found
