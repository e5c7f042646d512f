import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import suffix
from quarry.llm.queries import op2_suffix_dedup

from . import brute

SHAPE = "doc_id long, text string, spans string, node int"


def expected(docs, length, keep):
    data, masks = brute.covered([t for _, t in docs], length, keep)
    out = []
    for (i, _), b, m in zip(docs, data, masks):
        kept = bytes(x for x, gone in zip(b, m) if not gone)
        runs = sum(1 for k in range(len(m)) if m[k] and (k == 0 or not m[k - 1]))
        out.append((i, len(b), sum(m), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(spark, docs, length, keep):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SHAPE)
    got = suffix.deduplicate(frame, length=length, keep=keep).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, out = [text(60) for _ in range(4)], []
    for i in range(60):
        body = [text(rng.randint(0, 40)), rng.choice(shared), text(rng.randint(0, 20))]
        if i % 3 == 0:  # one byte changed in the middle
            at = rng.randrange(len(body[1]))
            body[1] = body[1][:at] + "Z" + body[1][at + 1 :]
        out.append((i, " ".join(body)))
    return [*out, (60, "ab" * 200), (61, None), (62, ""), (63, shared[0]), (64, shared[0]), (65, "aaaa" * 100)]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_against_brute_force(spark, docs, keep):
    assert made(spark, docs, 120, keep) == expected(docs, 120, keep)


def test_hot_anchors_are_split(spark, docs, monkeypatch):
    monkeypatch.setattr(suffix, "MOST", 2)
    assert made(spark, docs, 120, "none") == expected(docs, 120, "none")
    assert made(spark, docs, 120, "first") == expected(docs, 120, "first")


def test_whole_table(spark, sf_small):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op2_suffix_dedup(spark, sf_small).collect()), key=str)
    assert got == expected(docs, 400, "none")


def test_null_ids_repeats_and_empty_table(spark):
    text = "the quick brown fox jumps over the lazy dog and runs away " * 4
    rows = [(None, text), (None, text), (1, text[:150]), (1, "other")]
    got = made(spark, rows, 120, "none")
    assert got == expected(rows, 120, "none")
    assert made(spark, [(1, "x")], 120, "none") == [(1, 1, 0, 0, hashlib.sha256(b"x").hexdigest())]
    assert suffix.deduplicate(spark.createDataFrame([], SHAPE)).count() == 0


def test_longest_previous_factor():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab") for _ in range(90)) for _ in range(4)]
    order = suffix.SuffixOrder(strings, 20)
    factors = suffix.longest_previous_factor(order)
    flat = [(k, s) for k, x in enumerate(strings) for s in range(len(x) - 19)]
    for n, (k, s) in enumerate(flat):
        best = 0
        for j, t in flat[:n]:
            m = 0
            while m < 20 and strings[k][s + m] == strings[j][t + m]:
                m += 1
            best = max(best, m)
        assert factors[n] == best


def test_one_text_under_many_equal_rows(spark):
    from pyspark.sql import functions as F

    text = "".join(random.Random(5).choice("abcdefgh ") for _ in range(410))
    docs = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    rows = suffix.deduplicate(docs, length=400).groupBy("n_removed", "n_spans").count().collect()
    assert [tuple(r) for r in rows] == [(410, 1, 100_000)]


def test_runs_of_a_hot_anchor_do_not_meet_in_one_task(spark, monkeypatch):
    hot = [(i, 0, 7, 0, i, -i, 5, 0, 9) for i in range(2000)]  # one anchor hash, all runs different
    cold = [(i, 0, 100 + i % 500, 0, i, -i, 5, 0, 9) for i in range(2000)]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "4096", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)  # counts of all keys are no small table, as at scale
    try:
        _, same, _ = suffix._counted(spark.createDataFrame(hot + cold, suffix._RUN), 400, "none")
        rows = same.withColumn("file", F.input_file_name()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.key1, r.u1, r.copies, r.kinds) for r in rows) == sorted(
        [(7, r[4], 1, 2000) for r in hot] + [(r[2], r[4], 1, 4) for r in cold])
    per_task = Counter(r.file for r in rows if r.key1 == 7)
    assert len(per_task) > 1 and max(per_task.values()) < 1000
