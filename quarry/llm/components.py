"""Connected components of a link table by union-find and star contraction.

Each task joins about ``TASK_LINKS`` links by union-find and passes on one link
per node to its root.  Then a large-star and a small-star step tie every node's
neighbours to the smallest one, and so on in turn until nothing changes or the
links left fit one task.  A hub is never collected: the
smallest neighbour is an aggregate, and the tie is a join that the engine may
split.  Lineage is cut by a written table after every round.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved

TASK_LINKS = 20_000  # links that a task joins by union-find at once
_SCHEMA = pa.schema([("hi", pa.int64()), ("lo", pa.int64())])


def _find(parent: dict[int, int], x: int) -> int:
    root = x
    while (up := parent.get(root, root)) != root:
        root = up
    while x != root:
        parent[x], x = root, parent.get(x, x)
    return root


def _forest(batches: Iterable[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Links of a task -> one link (node, smallest node of its tree); flushed at ``most`` nodes."""
    parent: dict[int, int] = {}

    def rows() -> pa.RecordBatch:
        pairs = [(x, _find(parent, x)) for x in list(parent)]
        pairs = [p for p in pairs if p[0] != p[1]]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], schema=_SCHEMA)

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ra, rb = _find(parent, a), _find(parent, b)
            parent.setdefault(ra, ra)
            parent.setdefault(rb, rb)
            parent[max(ra, rb)] = min(ra, rb)
        if len(parent) > most:
            yield rows()
    if parent:
        yield rows()


def _local(links: DataFrame) -> DataFrame:
    return links.mapInArrow(_forest, "hi long, lo long").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    tied = links.join(least, "hi")
    return tied.where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(
        least.select("hi", F.col("m").alias("lo")))


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of links (a, b)."""
    a, b = links.columns[:2]
    now = saved(links.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        tasks = -(-mark[0] // TASK_LINKS)
        joined = saved(_local(now.coalesce(tasks)), "links")
        if tasks == 1:  # one task held all links, so its forest is final
            now = joined
            break
        now = saved(_small_star(_large_star(joined)), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
