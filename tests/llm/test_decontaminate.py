import random

import numpy as np
import pytest

from quarry.llm import decontaminate
from quarry.llm.common import WordHashes, shingle_hashes
from quarry.llm.queries import op7_decontamination

from . import brute


def found(spark, docs, items):
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(frame, bench).collect()}


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(8)
    word = lambda: rng.choice(["th", "re", "on", "an"]) + str(rng.randrange(300))
    items = [(k, " ".join(word() for _ in range(rng.randint(14, 60)))) for k in range(30)]
    items += [(30, "three short words"), (31, None), (32, ""), (33, items[0][1])]
    docs = []
    for i in range(80):
        w = (rng.choice(items[:30])[1]).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = word()
        before, after = ([word() for _ in range(rng.randint(0, 80))] for _ in range(2))
        docs.append((i, " ".join(before) + "\n" + "  ".join(w).title() + "\n" + " ".join(after)))
    return [*docs, (100, None), (101, ""), (102, "three short words"), (103, "word " * 4000), (104, items[3][1][:40])], items


def test_against_all_windows(spark, planted):
    docs, items = planted
    want = brute.leaks(docs, items)
    got = found(spark, docs, items)
    assert set(got) == set(want) and len(want) > 30
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_whole_table(spark, sf_small):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in op7_decontamination(spark, sf_small).collect()}
    assert got == set(brute.leaks(docs, items))


def test_several_rounds_and_empty_tables(spark, planted, monkeypatch):
    docs, items = planted
    whole = found(spark, docs[:20], items[:10])
    monkeypatch.setattr(decontaminate, "MOST_ITEMS", 4)
    assert set(found(spark, docs[:20], items[:10])) == set(whole)
    assert found(spark, [], items) == {} and found(spark, docs[:3], []) == {}


def test_rounds_do_not_change_similarities(spark, planted, monkeypatch):
    docs, items = planted
    common = " one two three four five six seven eight nine ten"
    items = [(k, t + common * (k % 2)) for k, t in items[:12]]
    docs = [(k, t + common * (k % 3 > 0)) for k, t in docs[:40]] + [(200 + k, " ".join(t.split()[1:])) for k, t in items]
    whole = found(spark, docs, items)
    monkeypatch.setattr(decontaminate, "MOST_ITEMS", 4)
    assert len(whole) > 12 and found(spark, docs, items) == whole


def test_blocks_find_everything_within_the_radius():
    rng = np.random.default_rng(0)
    index = decontaminate.Index([(0, " ".join(f"w{k}" for k in range(30)))], 5, WordHashes())
    own = np.unpackbits(index.prints[0])
    for distance in (0, 1, 31, 32, 62, 63):
        for _ in range(50):
            bits = own.copy()
            bits[rng.choice(256, distance, replace=False)] ^= 1
            assert list(decontaminate.candidates(np.packbits(bits)[None], *index.postings(np.array([0])))) == [(0, 0)]


def test_uneven_weights_are_found():
    """Items of 150 common shingles and 5 own ones, two of them changed: similarity 0.846."""
    rng = np.random.default_rng(0)
    for _ in range(100):
        words = [f"w{x}" for x in rng.integers(0, 1 << 60, 159)]
        known = WordHashes()
        common = shingle_hashes(known.of([w.encode() for w in words]), 5)[:150]
        index = decontaminate.Index([(0, " ".join(words))], 5, known, (1000, common, np.full(150, 1000)))
        changed = known.of([w.encode() for w in [*words[:-2], "other", "words"]])
        ((_, similarity, _),) = decontaminate.matches(changed, index, 0.8)
        assert abs(similarity - 0.846) < 1e-3


def test_postings_find_all_items_within_one_bit_of_a_block():
    import numpy as np

    from quarry.llm.common import WordHashes

    items = [(k, " ".join(f"w{(7 * k + j) % 50}" for j in range(12 + k % 5))) for k in range(40)]
    index = decontaminate.Index(items, 5, WordHashes())
    keys, of = index.postings(np.arange(5, 40))
    assert (np.diff(keys) >= 0).all() and len(keys) == 35 * decontaminate.BLOCKS * 9
    draw = np.random.default_rng(1)
    prints = np.concatenate([index.prints[:8], draw.integers(0, 256, (30, decontaminate.BLOCKS), np.uint8)])
    got = set(decontaminate.candidates(prints, keys, of))
    want = {(w, k) for w in range(len(prints)) for k in range(5, 40) if (np.bitwise_count(prints[w] ^ index.prints[k]) <= 1).any()}
    assert got == want


def test_index_is_made_once_per_worker():
    decontaminate._INDEXES.clear()
    a = decontaminate._index("x", [(1, "a b c d e f")], 5, None)
    assert decontaminate._index("x", [], 5, None) is a
    assert decontaminate._index("y", [], 5, None) is not a and list(decontaminate._INDEXES) == ["y"]
