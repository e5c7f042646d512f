import random
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from quarry.llm import quality
from quarry.llm.queries import op10_quality_rules

from . import brute


def test_counts_of_the_whole_table(spark, sf_small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = op10_quality_rules(spark, sf_small).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.quality_counts(texts[r.doc_id])
        assert {k: r[k] for k in want} == want


def test_counts_of_odd_texts(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "é́ x漢\x0b| <a>", "a b c d e f g h " * 3, "a " * 40, "line\nline\n\nline\n  \n  ", "x" * 50_000]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    rows = [(i, t, "n", 5) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words string, n_lines int")
    for r in quality.with_signals(frame).collect():
        want = brute.quality_counts(texts[r.doc_id])
        assert {k: r[k] for k in want} == want
    assert quality.with_signals(frame.limit(0)).count() == 0


@pytest.mark.parametrize("p", [0.003, 0.02, 0.3])
def test_binomial_tail(spark, p):
    cases = [(k, n) for n in (1, 10, 300, 4000) for k in (0, 1, 2, 5, 11, 60) if k <= n]
    frame = spark.createDataFrame(cases, "k long, n long")
    exact = Fraction(p)
    for r in frame.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect():
        if r.k >= r.n * p:
            assert r.t == 1.0
        else:
            want = float(sum(comb(r.n, i) * exact**i * (1 - exact) ** (r.n - i) for i in range(r.k + 1)))
            assert r.t == pytest.approx(want, rel=1e-8)


def cutoffs_by_hand(rows, risk, delta):
    strata = sorted({s for s, *_ in rows}, key=str)
    out = {}
    for s in strata:
        for rule, (_, cuts) in quality.RULES.items():
            p = risk / len(quality.RULES)
            good = [v[rule] for t, v, g in rows if t == s and g]
            bad = [v[rule] for t, v, g in rows if t == s and not g]
            best = None
            for place, c in enumerate(cuts):
                k, n = sum(x > c for x in good), len(good)
                tail = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if n else 1.0
                if k >= n * p or tail > delta / len(quality.RULES) / len(strata):
                    break
                caught = sum(x > c for x in bad)
                gain = (caught / len(bad) if bad else 0) - k / n
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, c, caught)
            if best and best[2]:
                out[s, rule] = best[1]
    return out


def test_cutoffs_are_certified_per_stratum(spark):
    rng = random.Random(3)
    rows, labels, plain = [], [], []
    for i in range(1500):
        stratum = ["a", "b", None][i % 3]
        good = rng.random() < 0.8
        signal = {r: rng.random() * (0.04 if good and rng.random() < 0.995 else 3) for r in quality.RULES}
        rows.append((i, stratum, False, *signal.values(), "x"))
        labels += [(i, int(good), 0)] * (1 + i % 2)
        plain.append((stratum, signal, good))
    shape = "doc_id long, lang string, base_failed boolean, " + ", ".join(f"signal_{r} double" for r in quality.RULES) + ", rule string"
    frame = spark.createDataFrame(rows, shape)
    marks = spark.createDataFrame([*labels, (99999, 1, 1), (3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.certified_cutoffs(frame, marks, risk=0.3, delta=0.05).collect()
    assert {(r.stratum, r.rule): r.cutoff for r in got} == cutoffs_by_hand(plain, 0.3, 0.05)
    assert got and all(r.k_good <= 0.3 * r.n_good for r in got)
    judged = quality.judge(frame, quality.certified_cutoffs(frame, marks, risk=0.3, delta=0.05)).collect()
    want = cutoffs_by_hand(plain, 0.3, 0.05)
    assert len(judged) == len(rows)
    for r in judged:
        assert r.kept == (not any(r[f"signal_{x}"] > want.get((r.lang, x), 1e9) for x in quality.RULES))


def test_no_labels_keeps_what_the_base_keeps(spark):
    frame = quality.with_signals(spark.createDataFrame([(1, "w " * 10, "a"), (2, " ".join(map(str, range(30))), None)], "doc_id long, text string, lang string"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.judge(frame, quality.certified_cutoffs(frame, none)).collect()
    assert {r.doc_id: r.kept for r in got} == {1: False, 2: True}
