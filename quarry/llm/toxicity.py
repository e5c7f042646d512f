"""Toxicity scores by a character n-gram linear classifier on naive Bayes features.

Features are the distinct character 3-, 4- and 5-grams of the whole lower-cased
text, hashed to ``DIM`` places.  Each place has the log-count ratio
``r = ln((p / |p|) / (q / |q|))`` of its smoothed document counts among toxic
and other labelled texts; a logistic regression is trained on the features
scaled by ``r``.

The counts cover all training rows.  The regression is fitted on at most
``sample`` rows of each label, those of the smallest hash of their id, weighted
so that the labels keep their shares.  Every text is scored in full.  The driver
receives ``DIM`` pairs of counts and the features of the sample, of which
``sample_bytes`` bounds each label's bytes: with very long texts fewer rows are
taken (one at least, of 4 x ``DIM`` bytes at most).

Defined cases: null and empty texts have no features and get the score of the
intercept; a document labelled twice is toxic if any label says so; null labels
are ignored; without labels of both kinds every score is the smoothed share of
toxic labels; null ids are not held out; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import GOLDEN, small_batches

DIM = 1 << 18
ORDERS = (3, 4, 5)
MOST_LABELS = 1_000_000  # labels (id and mark) that may be broadcast


class Grams:
    """Distinct hashed n-grams of a text."""

    def __init__(self):
        self.seen = np.zeros(DIM, bool)

    def of(self, text: str | None) -> np.ndarray:
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        run = points + np.uint64(1)
        for n in range(2, ORDERS[-1] + 1):
            if len(points) < n:
                break
            run = run[:-1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(n)
            if n in ORDERS:
                self.seen[(run * GOLDEN) >> np.uint64(64 - 18)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, count = Grams(), np.zeros((2, DIM), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in small_batches(batches, "text"):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            count[toxic, grams.of(text)] += 1
            rows[toxic] += 1
    if rows.any():
        at = np.flatnonzero(count.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(count[1, at], rows[1])),
             pa.array(np.append(count[0, at], rows[0]))], names=["place", "toxic", "other"])


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = Grams()
    for batch in small_batches(batches, "text"):
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array([grams.of(t).astype("<i4").tobytes() for t in batch.column(0).to_pylist()], pa.binary())],
            names=["toxic", "places"])


def fit_logistic(places: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, ratio: np.ndarray,
                 l2: float, rounds: int = 40, block: int = 128) -> tuple[np.ndarray, float]:
    """Weights per place (already scaled by ``ratio``) and intercept, by limited-memory BFGS.

    Rows are visited in blocks, so only one block's products are held at a time.
    """
    share = weights / weights.sum()
    blocks = []
    for at in range(0, len(places), block):
        part = places[at : at + block]
        lengths = np.array([len(p) for p in part])
        full = np.flatnonzero(lengths)  # rows without features have the intercept only
        blocks.append((slice(at, at + len(part)), np.concatenate(part).astype(np.int32), lengths, full,
                       (np.cumsum(lengths) - lengths)[full]))

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        scaled, grad, loss = x[:-1] * ratio, np.zeros(DIM + 1), 0.0
        for rows, flat, lengths, full, starts in blocks:
            margin = np.full(len(lengths), x[-1])
            if len(full):
                margin[full] += np.add.reduceat(scaled[flat], starts)
            loss += float(share[rows] @ (np.logaddexp(0, margin) - labels[rows] * margin))
            error = share[rows] * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels[rows])
            grad[:-1] += np.bincount(flat, np.repeat(error, lengths), DIM)
            grad[-1] += error.sum()
        grad[:-1] = grad[:-1] * ratio + l2 * x[:-1]
        return loss + 0.5 * l2 * float(x[:-1] @ x[:-1]), grad

    x = np.zeros(DIM + 1)
    loss, grad = value(x)
    memory: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        move, used = -grad, []
        for ds, dg in reversed(memory):
            part = float(ds @ move) / float(ds @ dg)
            used.append(part)
            move = move - part * dg
        if memory:
            ds, dg = memory[-1]
            move = move * float(ds @ dg) / float(dg @ dg)
        for (ds, dg), part in zip(memory, reversed(used)):
            move = move + (part - float(dg @ move) / float(ds @ dg)) * ds
        slope, step = float(grad @ move), 1.0 if memory else min(1.0, 1.0 / float(np.abs(grad).sum()))
        for _ in range(20):
            after, grad_after = value(x + step * move)
            if after <= loss + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        ds, dg = step * move, grad_after - grad
        x, gain, loss, grad = x + ds, loss - after, after, grad_after
        if float(ds @ dg) > 1e-12:
            memory = [*memory[-7:], (ds, dg)]
        if gain < 1e-7 * max(1e-6, loss):
            break
    return (x[:-1] * ratio).astype(np.float32), float(x[-1])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = 1024,
          sample_bytes: int = 128 << 20, smoothing: float = 1.0, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """(weights, intercept) from the labelled rows that are not held out."""
    marks = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out("doc_id"))
             .groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    small = marks.limit(MOST_LABELS + 1).count() <= MOST_LABELS
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("text"))
    counted = (texts.join(F.broadcast(marks) if small else marks, "__id").select("text", "toxic")
               .mapInArrow(_counts, "place int, toxic long, other long")
               .groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    table = counted.toArrow()  # at most DIM + 1 rows
    place = table.column("place").to_numpy()
    count = np.zeros((2, DIM + 1), np.float64)  # place -1: the number of rows
    count[1, place], count[0, place] = table.column("toxic").to_numpy(), table.column("other").to_numpy()
    n = count[:, -1]
    if not n.all():
        share = (n[1] + 1) / (n.sum() + 2)
        return np.zeros(DIM, np.float32), float(np.log(share / (1 - share)))
    p, q = count[1, :-1] + smoothing, count[0, :-1] + smoothing
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    picked = None
    for label in (0, 1):
        part = marks.where(F.col("toxic") == label).orderBy(F.xxhash64("__id"), "__id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    picked = _within(texts, picked, sample_bytes)
    fitted = texts.join(F.broadcast(picked), "__id").select("text", "toxic").mapInArrow(  # 2 x sample rows at most
        _features, "toxic int, places binary").toArrow()
    y = fitted.column("toxic").to_numpy().astype(np.float32)
    places = [np.frombuffer(b, "<i4") for b in fitted.column("places").to_pylist()]
    share = n / n.sum() / np.maximum(1, [(y == 0).sum(), (y == 1).sum()])
    return fit_logistic(places, y, share[y.astype(int)], ratio, l2)


def _within(texts: DataFrame, picked: DataFrame, most: int) -> DataFrame:
    """The picked ids (__id, toxic) up to ``most`` bytes of features for each label, in the order of their hash."""
    size = F.lit(4) * F.least(F.lit(len(ORDERS)) * F.length(F.coalesce("text", F.lit(""))), F.lit(DIM))
    sizes = (texts.join(F.broadcast(picked), "__id").groupBy("__id", "toxic").agg(F.sum(size.cast("long")).alias("size"))
             .select("toxic", F.xxhash64("__id").alias("h"), "__id", "size").collect())  # a row per picked id
    room, kept = {}, []
    for r in sorted(sizes):
        left = room.get(r.toxic, most)
        if r.toxic not in room or r.size <= left:
            kept.append((r["__id"], r.toxic))
            room[r.toxic] = left - r.size
    return texts.sparkSession.createDataFrame(kept, "__id long, toxic int")


def _scores(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    weights, bias = model.value
    grams = Grams()
    for batch in small_batches(batches, "text"):
        margin = np.array([float(weights[grams.of(t)].sum(dtype=np.float64)) + bias for t in batch.column(1).to_pylist()])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(margin, -60, 60))))],
                                         names=["doc_id", "score"])


def score(docs: DataFrame, model: tuple[np.ndarray, float], *, id_col: str = "doc_id", text_col: str = "text",
          cutoff: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIM floats
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(partial(_scores, model=sent), "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= cutoff).cast("int").alias("predicted"))
