"""Repeated passages against a word-by-word version."""

import random

import numpy as np
import pytest

from quarry.llm import passages, substring
from quarry.llm.queries import op6_substring_dedup

from . import brute

SHAPE = "doc_id long, text string, start int, runs string, req long"


def spans_of(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, 0, "s", 1) for i, t in docs], SHAPE)
    out = {}
    for r in passages.repeated_passages(frame, **options).collect():
        out.setdefault(r.node if r.node < substring.NO_ID else None, []).append((r.start, r.length, r.words, r.first_node))
    return {i: sorted(s) for i, s in out.items()}


def planted(seed, n_docs=90, marks=True):
    """Documents with passages of 25 to 70 words that start and end within lines."""
    draw = random.Random(seed)
    ends = [".", ",", ";", "!", "?", ":"] if marks else [""]
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(2, 11)))
    prose = lambda n: [word() + (draw.choice(ends) if draw.random() < 0.13 else "") for _ in range(n)]
    pool = [prose(draw.randrange(25, 70)) for _ in range(12)]
    docs = []
    for i in range(n_docs):
        w = prose(draw.randrange(0, 80))
        for _ in range(draw.randrange(0, 3)):
            at = draw.randrange(len(w) + 1)
            copy = [x.upper() if draw.random() < 0.1 else x for x in draw.choice(pool)]
            if draw.random() < 0.2:
                copy[draw.randrange(len(copy))] = "edited"
            w[at:at] = copy
        docs.append((i, "".join(x + draw.choice([" ", " ", " ", "  ", "\n"]) for x in w)))
    return docs


@pytest.mark.parametrize("seed,marks", [(1, True), (2, True), (3, False)])
def test_against_brute_force(spark, seed, marks):
    docs = planted(seed, marks=marks)
    want = brute.passages(docs, 20)
    assert len(want) > (20 if marks else 5)
    assert spans_of(spark, docs) == want


def test_planted_passages_are_caught_and_the_rest_stays(spark):
    docs = planted(5)
    spans = spans_of(spark, docs)
    seen, caught, all_of = set(), 0, 0
    for i, t in docs:
        w = brute.words(t.lower())
        cuts = spans.get(i, [])
        left = brute.words("".join(c if not any(s <= k < s + n for s, n, *_ in cuts) else " " for k, c in enumerate(t)).lower())
        grams = [tuple(w[k : k + 25]) for k in range(len(w) - 24)]
        kept = {tuple(left[k : k + 25]) for k in range(len(left) - 24)}
        again = [g for g in grams if g in seen]
        all_of += len(again)
        caught += sum(g not in kept for g in again)
        seen.update(grams)
    assert all_of > 500 and caught >= 0.95 * all_of


@pytest.mark.parametrize("room", [1, 4])
def test_runs_beyond_the_fetched_words(spark, monkeypatch, room):
    monkeypatch.setattr(passages, "ROOM", room)
    long = " ".join(f"w{k}" for k in range(23)) + ". " + " ".join(f"a{k} b{k}, c{k}." for k in range(150))
    docs = [(1, "start one two. " + long), (2, long + " ends otherwise"), (3, "x " + long[len(long) // 2 :])]
    assert spans_of(spark, docs) == brute.passages(docs, 20)


def test_odd_rows(spark):
    body = " ".join(f"w{k}" + "." * (k % 9 == 8) for k in range(40))
    docs = [(3, body), (3, body), (None, body), (4, body + "\nown words here"), (5, None), (6, ""), (7, " \n\t"),
            (8, "the " * 400), (9, "x " + "the " * 300), (10, "É " + body.upper()), (11, "x" * 100_000)]
    got = spans_of(spark, docs)
    assert got[None] == [(0, len(body), 40, 3)] and got[4] == [(0, len(body), 40, 3)] and got[10] == [(2, len(body), 40, 3)]
    assert set(got) <= {None, 4, 8, 9, 10}
    assert spans_of(spark, []) == {}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    cut = substring.remove_spans(frame, passages.repeated_passages(frame))
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert (None, "") in texts and (4, "own words here") in texts and (10, "É ") in texts and (3, body) in texts


def test_rows_under_one_id(spark):
    body = " ".join(f"w{k}" + "." * (k % 9 == 8) for k in range(40))
    frame = spark.createDataFrame([(1, body + " a"), (1, body + " b")], "doc_id long, text string")
    assert passages.repeated_passages(frame).count() == 1  # one of the two is the source


def test_a_unit_of_a_third_of_all_rows(spark):
    from pyspark.sql import functions as F

    body = " ".join(f"w{k}" + "." * (k % 9 == 8) for k in range(30))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("own"), "id", F.lit(" " + body)))
                                    .otherwise(F.concat(F.lit("other text "), "id")).alias("text"))
    rows = passages.repeated_passages(docs).groupBy("words", "first_node").count().collect()
    assert [tuple(r) for r in rows] == [(30, 0, 1999)]


def test_whole_small_table(spark, sf_small):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    got = {}
    for r in op6_substring_dedup(spark, sf_small).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.n_words, r.first_doc_id))
    assert {i: sorted(s) for i, s in got.items()} == brute.passages(docs, 20)


def test_runs_of_keeps_stretches_with_a_seed_only():
    b = np.arange(100, dtype=np.uint64)
    a = b.copy()
    a[50] = 1000
    runs, more = passages.runs_of(b, a, 0, 0, 0, np.array([[10, 5]]), 32, 20)
    assert runs == [(0, 50)] and not more
    runs, more = passages.runs_of(b, a, 0, 0, 0, np.array([[10, 5], [60, 4]]), 32, 20)
    assert runs == [(0, 50), (51, 100)] and more  # the last one ends where the words given end
    assert passages.runs_of(b, a, 0, 0, 0, np.array([[48, 5]]), 32, 20) == ([], False)


def test_units_are_nested():
    known = passages.Words()
    a, starts, stops = passages.units("One two three four. Five, six\nseven eight nine, ten\n\na b, c d", known)
    assert [(int(s), int(e)) for s, e in zip(starts, stops)] == [(0, 4), (5, 9), (6, 10), (10, 14)]  # one goes on over a line break
    assert len(a) == 14
