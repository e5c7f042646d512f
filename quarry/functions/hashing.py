"""Deterministic pseudo-random numbers from row keys.

``uniform(key, seed)`` maps a row key to [0, 1) with md5, so a sample or a
split depends only on the row's own key: it does not change with the
partitioning, survives a lost executor (recomputed rows land on the same
side), and an SQL engine with md5 reproduces it row by row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def uniform(key: str | Column, seed: int) -> Column:
    """First 32 bits of md5(seed || '|' || key) as a double in [0, 1)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}|"), k.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(TWO_POW_32)
