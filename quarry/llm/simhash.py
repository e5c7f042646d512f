"""Near-duplicate documents by SimHash and anchor points of a covering code.

A document's fingerprint has 64 bits: bit j is 1 if more than half of the hashes
of its word shingles have it.  Fingerprints that differ in at most ``distance``
bits (3 at most) are linked.

Two such fingerprints differ in at most one bit of the low or of the high half.
The anchors of a half are the points of a covering code: the perfect Hamming code
of 31 bits, times the free 32nd bit, so every half lies within 1 bit (the covering
radius) of exactly one anchor, its home.  A half goes to its home and to every
other anchor within 1 + 1 bits (radius plus threshold), 17 in all at most.  If x
and y differ in at most one bit of a half, y therefore comes to the home of x.
At an anchor the fingerprints at home are compared with all others there, on all
64 bits: no link is missed, whatever the data.

Equal fingerprints form a class and go on as one row.  Copies at anchors that are
nobody's home are dropped by a join with the homes, those alone at an anchor by a
count.  Anchors with more than ``GROUP`` members are split into blocks of homes
and blocks of members, every pair of which is a group of its own, so no group
exceeds about twice that.  A task compares its groups in blocks of rows and
passes on a spanning forest instead of all links; components are found by
union-find and star contraction.

Defined cases: null or empty text has fingerprint zero and is linked like any
other; rows that share a doc_id are documents of their own; rows with a null id
take part and get the smallest non-null id of their component, or null; repeated
rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved, small_batches, utf8
from quarry.llm.components import _forest, components

SEED = 42
GROUP = 4096  # members of an anchor that are compared in one group
_PIECE = 65_025  # shingles whose bits are held at once
_U = np.uint64


def shingle_bytes(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The shingles of a text in pieces (A-Z lower-cased, split at ASCII white space, joined by spaces)."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= size:
        if words:
            yield [joined]
        return
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts, stops = (stops - lengths)[: len(words) - size + 1].tolist(), stops[size - 1 :].tolist()
    for k in range(0, len(starts), _PIECE):
        yield [joined[a:b] for a, b in zip(starts[k : k + _PIECE], stops[k : k + _PIECE])]


def fingerprint(text: bytes, size: int) -> int:
    """Bit j is 1 if it is set in over half of the shingles' XXH64."""
    total, n = np.zeros(64, np.int64), 0
    for piece in shingle_bytes(text, size):
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in piece), _U, len(piece))
        rows = np.zeros((-(-len(piece) // 255) * 255, 64), np.uint8)  # 255 rows of bits add up in a byte
        rows[: len(piece)] = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += np.add.reduce(rows.reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        n += len(piece)
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little")


def _prints(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        found = np.array([fingerprint(t, size) for t in utf8(batch.column(1))], _U)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "bits"])


# ------------------------------------------------------------ anchors ------

_CHECKS = [_U(sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)) for k in range(5)]  # of the Hamming code
_ONE, _LOW31, _SPARE = _U(1), _U((1 << 31) - 1), _U(1 << 31)
#: For a syndrome s, the 15 pairs of places i < j whose flips give a code word: i xor j = s.
_PAIRS = np.array([[(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < i ^ s] if s else [0] * 15
                   for s in range(32)], _U)


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of 32-bit values (n x 17; the first is the home), and which of them are valid."""
    syndrome = np.zeros(len(half), np.int64)
    for k, mask in enumerate(_CHECKS):
        syndrome |= (np.bitwise_count(half & mask) & 1).astype(np.int64) << k
    home = np.where(syndrome == 0, half, half ^ (_ONE << np.maximum(syndrome - 1, 0).astype(_U)))
    out = np.empty((len(half), 17), _U)
    out[:, 0], out[:, 1] = home, home ^ _SPARE  # the spare bit differs: one bit is left for the rest
    out[:, 2:] = half[:, None] ^ _PAIRS[syndrome]
    valid = np.ones(out.shape, bool)
    valid[syndrome == 0, 2:] = False  # a code word's next neighbours lie 3 bits away
    return out, valid


def _replicate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = batch.column(0).to_numpy(zero_copy_only=False).view(_U)
        keys, prints, homes = [], [], []
        for side in range(2):
            at, valid = anchors((bits >> _U(32 * side)) & _U(0xFFFFFFFF))
            keys.append((at | _U(side << 32))[valid])
            prints.append(np.broadcast_to(bits[:, None], at.shape)[valid])
            homes.append(np.broadcast_to(np.arange(17) == 0, at.shape)[valid])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(prints).view(np.int64)),
             pa.array(np.concatenate(homes))], names=["anchor", "bits", "home"])


def _links(group: np.ndarray, bits: np.ndarray, home: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``distance`` bits in rows sorted by group, homes first: every home with all after it."""
    at, step = np.flatnonzero(home), 1
    while True:
        at = at[at + step < len(bits)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            return
        near = np.bitwise_count(bits[at] ^ bits[at + step]) <= distance
        if near.any():
            yield bits[at[near]], bits[at[near] + step]
        step += 1


def _compare(batches: Iterable[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, i, j), homes first -> links, whole groups at a time."""
    held: list[np.ndarray] = []

    def pairs(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        anchor, i, j, bits, home = rows
        new = np.ones(len(bits), np.int64)
        new[1:] = (anchor[1:] != anchor[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        for a, b in _links(np.cumsum(new), bits, home, distance):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        rows[3] = rows[3].view(_U)
        if held:
            rows = [np.concatenate(both) for both in zip(held, rows)]
        last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]) | (rows[2] != rows[2][-1]))
        cut = last[-1] + 1 if len(last) else 0
        held = [r[cut:] for r in rows]
        if cut:
            yield from pairs([r[:cut] for r in rows])
    if held:
        yield from pairs(held)


def _forests(batches: Iterable[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    yield from _forest(_compare(batches, distance))


def links(prints: DataFrame, *, distance: int = 2, group: int = GROUP) -> DataFrame:
    """(hi, lo): links that connect distinct fingerprints ``bits`` as all those within ``distance`` do."""
    if not 0 <= distance <= 3:
        raise ValueError("halves guarantee 3 differing bits at most")
    rows = prints.select("bits").mapInArrow(_replicate, "anchor long, bits long, home boolean")
    homes = rows.where("home").groupBy("anchor").agg(F.count(F.lit(1)).alias("homes"))
    # Spark takes ``rows`` for as large as ``prints``, not 34 times that, and would broadcast it over the driver
    met = saved(rows.hint("merge").join(homes, "anchor"), "met")
    sizes = met.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / group)).cast("int")
    both = met.join(sizes, "anchor").withColumns({"hs": F.when(F.col("n") > group, parts("homes")).otherwise(1), "ms": parts("n")})
    own = lambda n, seed: F.pmod(F.xxhash64("bits", F.lit(seed)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    whole = both.where("hs = 1 AND ms = 1").select("anchor", F.lit(0).alias("i"), F.lit(0).alias("j"), "bits", "home")
    hot = both.where("hs > 1 OR ms > 1")
    as_home = hot.where("home").select("anchor", own("hs", 1).alias("i"), each("ms").alias("j"), "bits", "home")
    as_member = hot.select("anchor", each("hs").alias("i"), own("ms", 2).alias("j"), "bits", F.lit(False).alias("home"))
    groups = whole.unionByName(as_home).unionByName(as_member)
    return (groups.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j", F.desc("home"))
            .mapInArrow(partial(_forests, distance=distance), "hi long, lo long"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                    distance: int = 2) -> DataFrame:
    """(doc_id, bits, fingerprint, component, component_id) for every row of ``docs``.

    ``bits`` is the fingerprint as a long, ``component`` the smallest one linked to it
    directly or over others, ``component_id`` the smallest doc_id of these.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = saved(plain.mapInArrow(partial(_prints, size=size), "doc_id long, bits long"), "prints")
    classes = saved(sketch.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "classes")
    group = saved(components(links(classes, distance=distance)), "components").withColumnRenamed("node", "bits")
    least = classes.join(group, "bits").groupBy("component").agg(F.min("first_id").alias("least_id"))
    joined = group.join(least, "component")
    of = classes.join(joined, "bits", "left").select(
        "bits", F.coalesce("component", "bits").alias("component"),
        F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("least_id")).alias("component_id"))
    return sketch.join(of, "bits").select(
        "doc_id", "bits", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component", "component_id")
