"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

Rows and virtual nodes lie on a ring of ``CELLS`` cells.  A row belongs to the
first virtual node clockwise; if that shard is full, it goes on to the next
shard clockwise with room.  A shard takes at most its share of the rows: with
load factor 1 the shares differ by one row at most, so the counts are balanced
exactly, and only the rows that overflow leave their home shard.

The walk around the ring needs only the number of rows per cell: at most
``CELLS`` numbers, whatever the size of the table.  It yields ranges
(cell, rank from, rank to, shard, slot), at most one per cell and shard, which
are broadcast.  Rows are ranked within their cell only, so nothing is sorted
globally, and slots are gapless by construction.  Equal rows are counted before
they are dealt out, so a row that is repeated often costs one row until then,
and equal texts with different ids lie in different cells.

Defined cases: null text has no bytes (size 1) and the checksum of the empty
text; null ids and repeated rows are placed like others; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved

CELLS = 1 << 16


def ring(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in ring order; a shard's nodes don't depend on the number of shards."""
    return sorted((int(hashlib.md5(f"shard {s} node {v}".encode()).hexdigest()[:4], 16), s)
                  for s in range(shards) for v in range(virtual))


def walk(counts: dict[int, int], shards: int, virtual: int = 128, load: float = 1.0) -> list[tuple]:
    """(cell, rank_from, rank_to, shard, slot): which shard takes which ranks of each cell."""
    nodes = ring(shards, virtual)
    cells = [c for c, _ in nodes]
    total = sum(counts.values())
    # a load factor of 1 shares the remainder out one by one; a larger one rounds the share up
    room = [total // shards + (s < total % shards) if load <= 1 else -(-int(total * load) // shards) + 1 for s in range(shards)]
    used = [0] * shards
    plan = []
    for cell in sorted(counts):
        left, rank, at = counts[cell], 0, bisect_left(cells, cell)
        while left:
            shard = nodes[at % len(nodes)][1]
            take = min(left, room[shard] - used[shard])
            if take:
                plan.append((cell, rank, rank + take, shard, used[shard]))
                used[shard] += take
                rank, left = rank + take, left - take
            at += 1
    return plan


def shard(docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text",
          virtual: int = 128, load: float = 1.0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, home_shard) for every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_crc32", "size"))
    rows = saved(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"))
        .withColumn("key", key)
        .groupBy("doc_id", "size", "text_crc32", "key").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("cell", F.conv(F.substring("key", 1, 4), 16, 10).cast("int")), "sharded_rows")
    counts = {r[0]: r[1] for r in rows.groupBy("cell").agg(F.sum("copies")).collect()}  # at most CELLS rows
    nodes = ring(shards, virtual)
    cells = [c for c, _ in nodes]
    plan = [(*p, nodes[bisect_left(cells, p[0]) % len(nodes)][1]) for p in walk(counts, shards, virtual, load)]
    shape = "array<struct<cell int, rank_from bigint, rank_to bigint, shard int, slot bigint, home_shard int>>"
    names = ("cell", "rank_from", "rank_to", "shard", "slot", "home_shard")
    ranges = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps([dict(zip(names, p)) for p in plan])), shape)))
    in_cell = Window.partitionBy("cell").orderBy("key", "doc_id")
    ranked = rows.withColumn("upto", F.sum("copies").over(in_cell)).withColumn("first", F.col("upto") - F.col("copies"))
    placed = ranked.join(F.broadcast(ranges), "cell").where("first < rank_to AND upto > rank_from")
    return (placed.withColumn("rank", F.explode(F.sequence(F.greatest("first", "rank_from"), F.least("upto", "rank_to") - 1)))
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("slot") + F.col("rank") - F.col("rank_from")).alias("slot"), "home_shard"))
