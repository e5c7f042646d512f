import zlib
from bisect import bisect_left
from collections import Counter

from quarry.llm import sharding
from quarry.llm.queries import op4_sharding


def by_hand(keys, shards, virtual=128):
    """Keys one by one in ring order: each goes clockwise to the first shard with room."""
    nodes = sharding.ring(shards, virtual)
    cells = [c for c, _ in nodes]
    room = [len(keys) // shards + (s < len(keys) % shards) for s in range(shards)]
    out = []
    for cell in sorted(keys):
        at = bisect_left(cells, cell)
        while not room[shard := nodes[at % len(nodes)][1]]:
            at += 1
        room[shard] -= 1
        out.append((cell, shard))
    return Counter(out)


def test_walk_equals_one_by_one():
    import random

    rng = random.Random(2)
    for n, shards in ((0, 4), (3, 16), (1000, 16), (5003, 7)):
        keys = [rng.randrange(sharding.CELLS) if k % 3 else 77 for k in range(n)]
        plan = sharding.walk(dict(Counter(keys)), shards)
        got = Counter({})
        for cell, lo, hi, shard, _ in plan:
            got[cell, shard] += hi - lo
        assert got == by_hand(keys, shards)


def test_whole_table(spark, sf_small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = op4_sharding(spark, sf_small).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        text = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "rows", None)
    counts = Counter(r.shard for r in got)
    assert set(counts) <= set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))


def test_nulls_repeats_hot_rows_and_empty_table(spark):
    rows = [(1, "same", "x")] * 400 + [(None, None, "y")] * 30 + [(i, "t" * (i % 5), "z") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.shard(frame, 8).collect()
    counts = Counter(r.shard for r in got)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(t or "") + 1) for i, t, _ in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert sharding.shard(frame.limit(0), 8).count() == 0


def test_growth_moves_little():
    """One more shard: with room to spare, few rows move between the old shards."""
    counts = {c: 1 for c in range(0, sharding.CELLS, 4)}
    place = lambda n: {c: s for c, _, _, s, _ in sharding.walk(counts, n, load=1.25)}
    before, after = place(16), place(17)
    moved = sum(before[c] != after[c] for c in counts)
    assert moved < 0.25 * len(counts)
    load = Counter(after.values())
    assert max(load.values()) <= 1.25 * len(counts) / 17 + 2
