"""SimHash near-duplicates against all pairs by hand."""

import random

import numpy as np
import pytest
import xxhash

from quarry.llm import simhash
from quarry.llm.queries import op13_simhash_dedup
from tests.llm.brute import LOWER, words

SHAPE = "doc_id long, text string, bits string"


def print_of(text, size=3):
    w = words((text or "").translate(LOWER))
    grams = [" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def by_hand(prints, distance):
    """[(id, fingerprint)] -> smallest non-null id reachable, per row."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= distance:
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [least.get(root(k)) for k in range(len(prints))]


def test_fingerprints():
    draw = random.Random(1)
    texts = ["", " \n", "One", "one TWO", "a b c", "a  b\tc d", "É é Ü ü ß 你 好", " ".join(draw.choice("abcdé") * draw.randrange(1, 9) for _ in range(700))]
    for t in texts:
        assert simhash.fingerprint(t.encode(), 3) == print_of(t), t


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = " ".join(str(k % 977) for k in range(5000))
    want = simhash.fingerprint(text.encode(), 3)
    monkeypatch.setattr(simhash, "_PIECE", 300)
    assert simhash.fingerprint(text.encode(), 3) == want == print_of(text)


def test_the_code_covers_with_radius_one():
    draw = np.random.default_rng(2)
    x = draw.integers(0, 1 << 32, 4000, dtype=np.uint64)
    at, valid = simhash.anchors(x)
    near = np.bitwise_count(at ^ x[:, None])
    assert (near[:, 0] <= 1).all() and (near[valid] <= 2).all()
    homes = simhash.anchors(at[:, 0])[0][:, 0]
    assert (homes == at[:, 0]).all()  # an anchor is its own home
    for place in range(32):  # one bit away: the other's home is among the anchors
        y = x ^ np.uint64(1 << place)
        home = simhash.anchors(y)[0][:, 0]
        assert ((at == home[:, None]) & valid).any(axis=1).all()


@pytest.mark.parametrize("distance,group", [(0, 4096), (1, 4096), (2, 4096), (3, 4096), (2, 2), (2, 5)])
def test_links_equal_all_pairs(spark, distance, group):
    draw = random.Random(distance)
    base = [draw.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    seen = set(base)
    for _ in range(260):
        x = draw.choice(base[:12] + [0])
        for _ in range(draw.randrange(0, 6)):
            x ^= 1 << draw.randrange(64)
        seen.add(x)
    prints = sorted(seen)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "bits long")
    from quarry.llm.components import components
    got = {r.node: r.component for r in components(simhash.links(frame, distance=distance, group=group)).collect()}
    want = by_hand(list(zip(signed, prints)), distance)
    assert [got.get(s, s) for s in signed] == want


def test_the_copies_at_anchors_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Spark sizes them by the table they were made of, 34 times too low."""
    plans, real = {}, simhash.saved

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return real(df, name)

    monkeypatch.setattr(simhash, "saved", recorded)
    spark.createDataFrame([(1,), (3,), (1 << 40,)], "bits long").write.parquet(str(tmp_path / "prints"))
    assert simhash.links(spark.read.parquet(str(tmp_path / "prints"))).count() == 2
    assert "SortMergeJoin" in plans["met"] and "Broadcast" not in plans["met"]


def rows():
    draw = random.Random(7)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "é", "zeta", "eta", "theta", "iota", "kappa"]
    out = [(1, None, "x"), (2, "", "x"), (3, " \t", None), (None, "", "x"), (4, "One", "x"), (5, "one", "x"), (None, "lone words here", "x"), (9, "tie tie", "x"), (9, "other", "x")]
    for k in range(10, 40):
        w = [draw.choice(vocabulary) for _ in range(120)]
        out.append((k, " ".join(w), "x"))
        for copy in range(draw.randrange(0, 4)):
            c = list(w)
            c[draw.randrange(len(c))] = "changed"
            out.append((k + 100 * (copy + 1), " ".join(c), "x"))
            out.append((k + 100 * (copy + 1), " ".join(c), "x"))
    return out


def test_query(spark, tmp_path):
    table = rows()
    spark.createDataFrame(table, SHAPE).write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_simhash_dedup(spark, str(tmp_path)).collect()
    prints = [(i, print_of(t)) for i, t, _ in table]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, by_hand(prints, 2))]
    order = lambda r: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in r)
    assert sorted([tuple(r) for r in got], key=order) == sorted(want, key=order)


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SHAPE).write.parquet(str(tmp_path / "documents.parquet"))
    assert op13_simhash_dedup(spark, str(tmp_path)).collect() == []


def test_whole_small_table(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    prints = [(i, print_of(t)) for i, t in docs]
    want = {i: (f"{p:016x}", c) for (i, p), c in zip(prints, by_hand(prints, 2))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op13_simhash_dedup(spark, sf_small).collect()}
    assert got == want
