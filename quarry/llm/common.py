"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_path

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it back.

    The table outlives lost executors; every call gets a fresh path, so no
    frame ever reads a path that is written again.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, name)}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # the write's shuffle files go when it ends, not when the driver collects its garbage
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def digest(col: Column | str) -> Column:
    """128-bit digest of a text (null counts as empty), for row identity."""
    return F.md5(F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64), elementwise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text, split at ASCII white space."""
    b = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = (b != 32) & ((b < 9) | (b > 13))
    turn = np.diff(inside)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


_BASE = 0x9DDFEA08EB382D69  # odd, so its powers have inverses modulo 2**64


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)  # a random number per byte value


def word_hashes(data: bytes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of every run data[start:stop], from prefix sums of a polynomial."""
    up, down = _powers(1 << max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[np.frombuffer(data, np.uint8)] * up[: len(data)], out=sums[1:])
    return mix((sums[stop] - sums[start]) * down[start])


def prefix_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` bytes."""
    up, down = _powers(1 << max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    n = len(data) - size + 1
    return mix((sums[size:] - sums[:-size]) * down[:n])


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, kept for at most ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in text order (empty if too short)."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix((out + GOLDEN) ^ word_hashes[k : k + n])
    return out


def small_batches(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Split Arrow batches so that the text of each is near ``max_bytes`` at most (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        if col.nbytes <= max_bytes:
            yield batch
            continue
        lengths = np.array([0 if v is None else v for v in pa.compute.binary_length(col).to_pylist()], np.int64)
        start, room = 0, 0
        for i, n in enumerate(lengths):
            if room + n > max_bytes and i > start:
                yield batch.slice(start, i - start)
                start, room = i, 0
            room += n
        yield batch.slice(start)


def utf8(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text of an Arrow column (null: empty)."""
    return [b"" if v is None else v for v in col.cast(pa.binary() if pa.types.is_string(col.type) else pa.large_binary()).to_pylist()]
