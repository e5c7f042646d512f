"""Ranked lexical search over an index stratified by document length.

A term's impact in a document depends on its count tf and on the document's
normaliser m (a whole number that grows with its length) alone.  Documents of
equal m form a stratum; in a stratum a term's postings are lists of documents by
tf, so its impact is computed once per tf and not per document.

Building the index: one pass turns each text into (tf, term) pairs of the terms
asked for; N, L and the df of terms are counted over all documents.  Each stratum
is dealt by a hash into blocks of about ``BLOCK`` documents, so a stratum with
a third of all rows becomes many rows of the index table, which is
sorted by m.

Searching: the highest tf of each term in a block bounds what an item can score
there.  Per item, blocks are visited in the order of these bounds.  The first
ones (with ``FIRST`` documents or more) give the item's k-th best score so far;
then every other block whose bound is not below it is visited, and what reaches
it is ranked.  The bounds are exact upper bounds and ties are kept, so no document
is missed.

Items go in rounds of about ``ROUND_TERMS`` terms and ``ROUND_ITEMS`` items: what
a task holds of them, and what reaches the driver (an item's terms, their weights,
its first visits and one score), is bounded by the round.  Scores are 64-bit whole numbers; weights are floored logarithms.

Defined cases: a null or empty text, or one without a term, scores nowhere and
counts nowhere; items without a term or a match have no rows; items that share
an id are one item with the terms of all; rows that share a doc_id are documents
of their own; documents with a null id come after equal scores with one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import saved, small_batches, utf8

# Fixed values of the score.
FLAT, SLOPE, TF_SCALE, M_SCALE, IMPACT = 50, 50, 1000, 20, 1_000_000_000

BLOCK = 1024  # documents of an index block, on average
FIRST = 1024  # documents that an item's first visits hold at least
ROUND_TERMS, ROUND_ITEMS = 200_000, 4_000  # of a round, on average
_CHUNK = 256  # blocks whose bounds a task holds at once
NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id: after all others

#: ASCII letters and digits (A-Z lower-cased) and all bytes of other characters stay, the rest splits.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        found = [sorted({t.decode() for t in terms(x)}) for x in utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["item_id", "terms"])


def _counts(batches: Iterable[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Texts -> doc_id, n (terms with repeats), numbers and counts of the terms asked for."""
    for batch in small_batches(batches, "text"):
        length, stops, ids, tfs = [], [0], [], []
        for text in utf8(batch.column(1)):
            words = terms(text)
            length.append(len(words))
            for word, tf in Counter(words).items():
                if (k := number.get(word)) is not None:
                    ids.append(k)
                    tfs.append(tf)
            stops.append(len(ids))
        at = pa.array(stops, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(length, pa.int64()), pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
             pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])


# -------------------------------------------------------------- index ------

_BLOCKS = ("m long, block int, n_docs int, docs array<long>, terms array<int>, tfs array<int>, stops array<int>, "
           "places array<int>")


def _block(m: int, block: int, docs: np.ndarray, term: np.ndarray, tf: np.ndarray, place: np.ndarray) -> dict:
    """One index row: lists (term, tf), each with the places of its documents."""
    order = np.argsort(term.astype(np.int64) << 32 | tf, kind="stable")  # places rise already
    term, tf, place = term[order], tf[order], place[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])
    first = np.flatnonzero(new)
    return {"m": m, "block": block, "n_docs": len(docs), "docs": docs, "terms": term[first], "tfs": tf[first],
            "stops": np.append(first[1:], len(term)).astype(np.int32), "places": place}


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (m, block, doc_id, terms, tfs) in order -> one row per block."""
    key, held = None, []

    def rows() -> pa.RecordBatch:
        docs = np.concatenate([h[0] for h in held])
        sizes = np.concatenate([h[1] for h in held])
        found = _block(*key, docs, np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held]),
                       np.repeat(np.arange(len(docs), dtype=np.int32), sizes))
        lists = {"docs": pa.int64()} | dict.fromkeys(("terms", "tfs", "stops", "places"), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([found["m"]], pa.int64()), pa.array([found["block"]], pa.int32()), pa.array([found["n_docs"]], pa.int32()),
             *(pa.ListArray.from_arrays(pa.array([0, len(found[c])], pa.int32()), pa.array(found[c], t)) for c, t in lists.items())],
            names=["m", "block", "n_docs", *lists])

    for batch in batches:
        m, block, docs = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        stops = batch.column(3).offsets.to_numpy()
        term, tf = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (3, 4))
        sizes, base = np.diff(stops), stops - stops[0]
        edges = np.flatnonzero((m[1:] != m[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, len(m)]):
            if a < b:
                if held and key != (m[a], block[a]):
                    yield rows()
                    held = []
                key = (m[a], block[a])
                held.append((docs[a:b], sizes[a:b], term[base[a] : base[b]], tf[base[a] : base[b]]))
    if held:
        yield rows()


def build_index(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index table of counted documents (doc_id, row, n, terms, tfs), of which N and L are given.

    ``row`` numbers the rows, so that equal ones spread over the blocks of their stratum too.
    """
    m = F.lit(100 - SLOPE) + F.expr(f"({SLOPE} * n * {n_docs}L) div {max(1, n_terms)}L")
    rows = counted.where(F.size("terms") > 0).select(m.cast("long").alias("m"), F.coalesce("doc_id", F.lit(int(NO_ID))).alias("doc_id"), "row", "terms", "tfs")
    sizes = rows.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "m").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    placed = dealt.select("m", "block", "doc_id", "terms", "tfs").repartition("m", "block").sortWithinPartitions("m", "block", "doc_id")
    return saved(placed.mapInArrow(_blocks, _BLOCKS), "index")


# ------------------------------------------------------------- search ------


class Items:
    """The items of a round: per item its terms' numbers and weights, flat, with stops."""

    def __init__(self, ids: list, of: list[list[int]], weight: np.ndarray):
        self.ids, self.stops = ids, np.cumsum([0, *map(len, of)])
        self.terms = np.array([t for item in of for t in item], np.int64)
        self.weight = weight  # by term number

    def bounds(self, terms: np.ndarray, tfs: np.ndarray, m: int) -> np.ndarray:
        """The most that each item can score in a block with these lists."""
        best = np.zeros(len(self.weight), np.int64)
        best[terms] = impact(tfs, m)  # lists of a term come by rising tf, and the last one stays
        return np.add.reduceat((best * self.weight)[self.terms], self.stops[:-1])


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return IMPACT * tf // (TF_SCALE * tf + M_SCALE * m)


def _bounds(batches: Iterable[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    """Per item the blocks of highest bounds: of every chunk those that may be among the first visits."""
    held: list[tuple] = []

    def rows() -> pa.RecordBatch:
        m, block, n = (np.array([h[i] for h in held]) for i in range(3))
        bound = np.stack([h[3] for h in held])
        order = np.argsort(-bound, axis=0, kind="stable")
        docs = n[order]
        place, item = np.nonzero((np.cumsum(docs, axis=0) - docs < FIRST) & (np.take_along_axis(bound, order, axis=0) > 0))
        at = order[place, item]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(m[at]), pa.array(block[at].astype(np.int32)), pa.array(bound[at, item]),
             pa.array(n[at].astype(np.int32))], names=["item", "m", "block", "bound", "n_docs"])

    for batch in batches:
        for m, block, n, terms, tfs in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), batch.column(4)):
            held.append((m, block, n, items.bounds(terms.values.to_numpy(), tfs.values.to_numpy(), m)))
            if len(held) == _CHUNK:
                yield rows()
    if held:
        yield rows()


def _scores(batches: Iterable[pa.RecordBatch], items: Items, least: np.ndarray, k: int,
            visits: set[tuple[int, int, int]] | None) -> Iterator[pa.RecordBatch]:
    """The k best documents of a block per item, of those that score ``least[item]`` or more."""
    cols = ("m", "block", "docs", "terms", "tfs", "stops", "places")
    for batch in batches:
        for row in zip(*(batch.column(batch.schema.get_field_index(c)) for c in cols)):
            m, block = row[0].as_py(), row[1].as_py()
            docs, term, tf, stops, places = (x.values.to_numpy() for x in row[2:])
            wanted = np.flatnonzero(items.bounds(term, tf, m) >= np.maximum(least, 1))
            if visits is not None:
                wanted = [i for i in wanted if (i, m, block) in visits]
            starts = np.concatenate([[0], stops[:-1]])
            value = np.repeat(items.weight[term] * impact(tf, m), stops - starts)  # one impact per list
            edges = np.append(np.flatnonzero(np.append(True, term[1:] != term[:-1])), len(term))
            at = {t: (starts[a], stops[b - 1]) for t, a, b in zip(term[edges[:-1]].tolist(), edges[:-1], edges[1:])}
            for i in wanted:
                score = np.zeros(len(docs), np.int64)
                for t in items.terms[items.stops[i] : items.stops[i + 1]].tolist():
                    if t in at:
                        a, b = at[t]
                        score[places[a:b]] += value[a:b]  # a document stands in one list of a term
                good = np.flatnonzero(score >= max(1, least[i]))
                if len(good) > k:
                    floor = np.partition(score[good], len(good) - k)[len(good) - k]
                    good = good[score[good] >= floor]
                    good = good[np.lexsort((docs[good], -score[good]))[:k]]
                if len(good):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(good), i, np.int32)), pa.array(docs[good]), pa.array(score[good])],
                        names=["item", "doc", "score"])


_FOUND = "item int, doc long, score long"


def _merged(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k best per item of all that a task found."""
    best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        i = batch.column(0)[0].as_py()
        docs, score = (batch.column(c).to_numpy() for c in (1, 2))
        if i in best:
            docs, score = np.concatenate([best[i][0], docs]), np.concatenate([best[i][1], score])
            if len(docs) > k:
                order = np.lexsort((docs, -score))[:k]
                docs, score = docs[order], score[order]
        best[i] = docs, score
    for i, (docs, score) in best.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), i, np.int32)), pa.array(docs), pa.array(score)],
                                         names=["item", "doc", "score"])


def _visit(batches, items: Items, least: np.ndarray, k: int, visits=None) -> Iterator[pa.RecordBatch]:
    yield from _merged(_scores(batches, items, least, k, visits), k)


def _search(index: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, rank, doc, score) of a round's items."""
    by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "block")
    bounds = index.select("m", "block", "n_docs", "terms", "tfs").mapInArrow(
        partial(_bounds, items=items), "item int, m long, block int, bound long, n_docs int")
    # FIRST documents are within the first FIRST blocks, so the window sees a bounded part of them
    near = bounds.withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= FIRST)
    first = near.withColumn("before", F.sum("n_docs").over(by_bound.rowsBetween(Window.unboundedPreceding, -1))).where(
        f"before IS NULL OR before < {FIRST}")
    visits = {(r.item, r.m, r.block) for r in first.select("item", "m", "block").collect()}
    least = np.zeros(len(items.ids), np.int64)
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    if visits:
        some = index.where(F.col("m").isin(sorted({m for _, m, _ in visits}))) if len(visits) <= 2000 else index
        seen = some.mapInArrow(partial(_visit, items=items, least=least, k=k, visits=visits), _FOUND)
        for r in seen.withColumn("rank", F.row_number().over(ranked)).where(f"rank = {k}").collect():
            least[r.item] = r.score
    found = index.mapInArrow(partial(_visit, items=items, least=least, k=k), _FOUND)
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("item", "rank", "doc", "score")


def search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = 50) -> DataFrame:
    """The k best documents of every item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).mapInArrow(
        _item_terms, f"item_id {kind}, terms array<string>")
    asked = saved(asked.select("item_id", F.explode("terms").alias("term")).distinct()
                  .groupBy("item_id").agg(F.collect_list("term").alias("terms")), "items")
    total, n_items = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)), F.count(F.lit(1))).first()
    rounds = max(-(-total // ROUND_TERMS), -(-n_items // ROUND_ITEMS))
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for turn in range(rounds):
        chosen = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == turn).collect()
        if not chosen:
            continue
        words = sorted({t for r in chosen for t in r.terms})
        number = {w: i for i, w in enumerate(words)}
        counted = saved(plain.mapInArrow(partial(_counts, number={w.encode(): i for w, i in number.items()}),
                                         "doc_id long, n long, terms array<int>, tfs array<int>")
                        .withColumn("row", F.monotonically_increasing_id()), "counted")
        n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(words), np.int64)
        for term, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[term] = n
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        index = build_index(counted, n_docs, n_terms)
        found = _search(index, Items([r.item_id for r in chosen], [[number[t] for t in r.terms] for r in chosen], weight), k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(chosen)], f"item int, item_id {kind}")
        out = out.unionByName(found.join(F.broadcast(names), "item").select(
            "item_id", "rank", F.when(F.col("doc") < int(NO_ID), F.col("doc")).alias("doc_id"), "score"))
    return out
