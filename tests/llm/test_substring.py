import random

from quarry.llm import substring
from quarry.llm.queries import op6_all_repeats

from . import brute

SHAPE = "doc_id long, text string, start int, spans string"


def cleaned(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, 0, "s") for i, t in docs], SHAPE)
    out = substring.remove_spans(frame, substring.repeated_spans(frame, **options))
    assert out.columns == ["doc_id", "text", "start", "spans", "__spans"]
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(4)
    line = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 12)))
    pool = [line() for _ in range(60)] + ["", "  "]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "É a\tb  c d e f\né A b c d e f"), (503, "\n".join(["long line of words"] * 3000))]
    for least in (1, 6, 20):
        spans = brute.repeated_lines(docs, least)
        want = sorted(((i, brute.cut(t, spans[i]) if i in spans else t) for i, t in docs), key=str)
        assert cleaned(spark, docs, min_words=least) == want


def test_all_repeats_of_the_whole_table(spark, sf_small):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    got = {}
    for r in op6_all_repeats(spark, sf_small).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length))
    want = brute.repeated_lines(docs, 1)
    assert {i: sorted(s) for i, s in got.items()} == want
    assert sum(map(len, want.values())) > sum(map(len, brute.repeated_lines(docs, 20).values()))


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(3, text), (3, text), (None, text), (4, text + "\nown words here"), (5, None)]
    assert cleaned(spark, rows) == sorted([(3, text), (3, text), (None, ""), (4, "own words here"), (5, None)], key=str)
    assert cleaned(spark, []) == []


def test_paragraphs(spark):
    part = "\n".join(" ".join(f"w{k}{j}" for k in range(15)) for j in range(2))
    rows = [(1, part + "\n\nfirst end"), (2, "start here\n \n" + part)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.node, r.start, r.length) for r in substring.repeated_spans(frame, unit="paragraph").collect()]
    assert got == [(2, 13, len(part))]
