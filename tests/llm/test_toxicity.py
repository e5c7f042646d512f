import zlib

import numpy as np

from quarry.llm import toxicity
from quarry.llm.queries import op5_toxicity

SF = "/root/testdata/sf0.1"  # sf0.01 has 37 toxic training rows only


def test_grams_are_the_distinct_ones():
    grams = toxicity.Grams()
    a, b = grams.of("abcabcabc"), grams.of("ABCabcabcabc")
    assert set(a) == set(b) and len(a) == 9  # three of each order
    assert len(grams.of(None)) == len(grams.of("")) == len(grams.of("ab")) == 0
    assert len(grams.of("é漢x")) == 1


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op5_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    toxic = [r.score for r in held if labels[r.doc_id] == 1]
    clean = [r.score for r in held if labels[r.doc_id] == 0]
    assert toxic and clean
    auc = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert auc > 0.95


def test_held_out_labels_are_not_learned(spark):
    docs = [(i, "awful trash clown" if i % 2 else "kind gentle words", "x") for i in range(200)]
    labels = [(i, i % 2 if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - i % 2) for i in range(200)]
    frame = spark.createDataFrame([*docs, (900, None, "y"), (None, "", "y"), (901, "w" * 40000, "y")], "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (5, None), (None, 1), (7777, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(frame, toxicity.train(frame, marks)).collect()}
    assert all(got[i].predicted == i % 2 for i in range(200))
    assert not got[None].held_out and got[900].score == got[None].score


def test_without_labels(spark):
    frame = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(frame, toxicity.train(frame, none)).collect()] == [0.5, 0.5]
    some = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.score(frame.limit(0), toxicity.train(frame, some)).count() == 0


def plain_grams(text):
    """Places of all distinct 3-, 4- and 5-grams, one by one."""
    t, out = [ord(c) for c in (text or "").lower()], set()
    for n in (3, 4, 5):
        for k in range(len(t) - n + 1):
            run = t[k] + 1
            for m in range(2, n + 1):
                run = (run * 0x100000001B3 + t[k + m - 1] + m) % 2**64
            out.add((run * 0x9E3779B97F4A7C15 % 2**64) >> 46)
    return sorted(out)


def test_against_a_plain_version(spark):
    """Log-count ratios from all training rows, the minimum of the penalised loss by Newton steps, and every row's score."""
    import random

    draw = random.Random(12)
    bad, good = ["awful", "trash", "clown", "vile"], ["kind", "gentle", "words", "calm"]
    text = lambda i: " ".join(draw.choice(bad if i % 3 == 0 and draw.random() < 0.4 else good) for _ in range(draw.randrange(1, 9)))
    docs = [(i, text(i) if i % 17 else draw.choice(["", None, "ok"])) for i in range(240)]
    labels = [(i, int(i % 3 == 0)) for i in range(200)]
    train = [(i, t, y) for (i, t), (_, y) in zip(docs, labels) if zlib.crc32(str(i).encode()) % 4 != 2]
    sets, y = [plain_grams(t) for _, t, _ in train], np.array([y for *_, y in train])
    places = sorted({p for s in sets for p in s})
    x = np.array([[p in set(s) for p in places] for s in sets], float)
    p, q = (x[y == c].sum(axis=0) + 1 for c in (1, 0))
    rest = toxicity.DIM - len(places)  # places that no text has count 1 each
    ratio = np.full(toxicity.DIM, np.log(q.sum() + rest) - np.log(p.sum() + rest))
    ratio[places] += np.log(p) - np.log(q)
    z, share = np.c_[x * ratio[places], np.ones(len(y))], 1 / len(y)  # all rows are in the sample: even weights
    penalty = np.append(np.full(len(places), 1e-4), 0)
    value = lambda v: share * np.sum(np.logaddexp(0, z @ v) - y * (z @ v)) + 0.5 * penalty @ (v * v)
    best = np.zeros(z.shape[1])
    for _ in range(60):
        s = 1 / (1 + np.exp(-z @ best))
        step = np.linalg.solve((z.T * (share * s * (1 - s))) @ z + np.diag(penalty + 1e-12), z.T @ (share * (s - y)) + penalty * best)
        size = 1.0
        while value(best - size * step) > value(best) and size > 1e-9:
            size /= 2
        best = best - size * step
    fit = lambda **o: toxicity.fit_logistic([np.array(s) for s in sets], y.astype(np.float32), np.full(len(y), share), ratio, 1e-4, **o)
    of = lambda w, b: np.append(w[places] / ratio[places], b)
    assert abs(value(of(*fit(rounds=600))) - value(best)) < 1e-5 * value(best)  # the same minimum
    weights, bias = fit()
    assert value(of(weights, bias)) < 1.02 * value(best)  # 40 rounds come near
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(frame, toxicity.train(frame, marks)).collect()}
    for i, t in docs:
        want = 1 / (1 + np.exp(-(sum(float(weights[k]) for k in plain_grams(t)) + bias)))
        assert abs(got[i] - want) < 2e-3


def test_the_sample_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (4000 if i % 2 else 10)) for i in range(60)], "doc_id long, text string")
    picked = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int").withColumnRenamed("doc_id", "__id")
    texts = docs.withColumnRenamed("doc_id", "__id")
    size = 4 * 3 * 4000
    kept = [tuple(r) for r in toxicity._within(texts, picked, 5 * size + 100).collect()]
    assert sum(y for _, y in kept) == 5 and sum(1 - y for _, y in kept) == 30
    assert len(toxicity._within(texts, picked, 1).collect()) == 2  # one of each at least
