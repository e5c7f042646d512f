import os

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import stages
from quarry.llm.queries import tokenizer_file

from . import brute

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, unit int"


def by_hand(docs, items):
    """The stages' kept documents, one after the other; too few labels here for any certified cutoff."""
    docs = [(i, t) for i, t in docs if not brute.quality_counts(t)["base_failed"]]
    yield docs
    found = brute.near_components(docs, 5, 80)
    docs = [d for d, (_, c) in zip(docs, found) if d[0] == c]
    yield docs
    spans = {i: [s[:2] for s in found] for i, found in brute.passages(docs, 20).items()}
    docs = [(i, brute.cut(t, spans[i]) if i in spans else t) for i, t in docs]
    docs = [(i, t) for i, t in docs if i not in spans or brute.words(t)]
    yield docs
    leaks = {d for d, _ in brute.leaks(docs, items)}
    yield [d for d in docs if d[0] not in leaks]


def test_stages_against_brute_force(spark, sf_small):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{sf_small}/{t}.parquet").select(*c).collect()]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    wanted = list(by_hand(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text")))
    for (name, stage), want in zip(corpus_pipeline.STAGES, wanted):
        docs = stage(spark, docs, sf_small)
        assert docs.columns == columns
        rows = docs.collect()
        assert sorted((r.doc_id, r.text) for r in rows) == sorted(want), name
        docs = spark.createDataFrame(rows, docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).collect()
    brute.check_pieces(wanted[-1], pieces, Tokenizer.from_file(tokenizer_file()))


def test_run_keeps_clean_documents(spark, sf_small):
    assert len(corpus_pipeline.STAGES) == 5
    got = corpus_pipeline.run(spark, sf_small)
    assert 100 < got.select("doc_id").distinct().count() < 200


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_odd_rows(spark, sf_small, stage):
    body = " ".join(f"word{k}" for k in range(60))
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (2, body, None, "s", 5, 1), (2, body, None, "s", 5, 1),
            (None, body, "en", None, 5, 1), (3, "x" * 200_000, "en", "s", 5, 1)]
    frame = spark.createDataFrame(rows, SHAPE)
    out = stage(spark, frame, sf_small)
    assert out.columns == frame.columns or stage is stages.packing
    assert out.count() <= 10_000
    assert stage(spark, frame.limit(0), sf_small).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark, sf_small):
    body = " ".join(f"word{k}" for k in range(60))
    rows = [(None, body, "en", "s", 5, 1), (2, body, "en", "s", 5, 1), (2, body, "en", "s", 5, 1), (9, body.upper(), "en", "s", 5, 1)]
    out = stages.minhash_near_dedup(spark, spark.createDataFrame(rows, SHAPE), sf_small)
    assert [r.doc_id for r in out.collect()] == [2]


def test_near_dedup_keeps_unlike_documents_without_ids(spark, sf_small):
    bodies = [" ".join(f"{c}{k}" for k in range(60)) for c in "uvwxyz"]
    rows = [(None, t, "en", "s", 5, 1) for t in [*bodies, bodies[0], bodies[1].upper(), None, "", " \n"]]
    rows.append((4, bodies[2], "en", "s", 5, 1))
    out = stages.minhash_near_dedup(spark, spark.createDataFrame(rows, SHAPE), sf_small).collect()
    assert sorted((r.text or "").lower().strip() for r in out) == ["", "", *sorted(bodies)]
    assert [r.doc_id for r in out if r.text == bodies[2]] == [4]


def test_stage_texts_and_lengths_agree(spark, sf_small):
    out = stages.substring_dedup(spark, spark.read.parquet(f"{sf_small}/documents.parquet"), sf_small)
    assert out.where(F.col("n_chars") != F.length("text")).count() == 0
    assert os.path.exists(tokenizer_file())


def labelled_table(folder, n=4000):
    """Documents of which some hold many symbols or marks, all labelled; written as the stage reads them."""
    import random

    import duckdb

    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 9)))
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        extra = draw.choice(["#", "$$", "%&", "!!", "?"]) if bad else ""
        w = [word() + (extra if draw.random() < 0.6 else "") for _ in range(draw.randrange(15, 60))]
        rows.append((i, "\n".join(" ".join(w[k : k + 9]) for k in range(0, len(w), 9)), "en" if i % 3 else "fr", "s", 0))
        labels.append((i, int(not bad), 0))
    con = duckdb.connect()
    for name, shape, values in (("documents", "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT", rows),
                                ("labels", "doc_id BIGINT, quality INTEGER, toxic INTEGER", labels)):
        con.execute(f"CREATE TABLE {name} ({shape})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(values[0]))})", values)
        con.execute(f"COPY {name} TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return con


def test_certified_cutoffs_take_effect_in_the_stage(spark, tmp_path):
    from quarry.llm.oracle import ORACLE

    con = labelled_table(tmp_path)
    want = {r[0]: (r[1], r[2]) for r in con.execute(f"SELECT doc_id, kept, base_failed FROM ({ORACLE['op10_quality_rules']})").fetchall()}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id for r in stages.quality_rules(spark, docs, str(tmp_path)).select("doc_id").collect()}
    assert got == {i for i, (kept, _) in want.items() if kept}
    by_cutoff = sum(not kept and not failed for kept, failed in want.values())
    assert by_cutoff > 300 and sum(i % 4 > 0 for i in got) > 2500


def test_labelled_signals_are_computed_once(spark, sf_small, monkeypatch):
    seen = []
    real = stages.quality.certified_cutoffs
    monkeypatch.setattr(stages.quality, "certified_cutoffs", lambda signals, labels: seen.append(signals) or real(signals, labels))
    out = stages.quality_rules(spark, spark.read.parquet(f"{sf_small}/documents.parquet"), sf_small)
    copies = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("array_sort(")
    assert copies(seen[0]) == 0 and copies(out) <= 4  # an evaluation has two, and the filter has the count twice


CLASHING = ["n_words", "kept", "signal_marks", "cutoff_symbols", "base_failed", "stratum", "__stratum", "__text", "__words", "__lines",
            "__spans", "__node", "__key", "__id", "__digest", "__hit", "__hit_key", "__kept_id", "node", "text_key", "unit", "start",
            "component", "component_id", "rep", "keys", "d1", "req", "runs", "chunk", "row", "at", "words", "item_id", "similarity",
            "prompt", "piece", "ids", "sequence_id", "offset", "length", "__column_0"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_columns_of_any_name_pass_unchanged(spark, sf_small, name, stage):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    wide = docs.select("*", *[(F.col("doc_id") * 100 + i).alias(c) for i, c in enumerate(CLASHING)])
    plain, out = stage(spark, docs, sf_small), stage(spark, wide, sf_small)
    if name == "packing":
        tally = lambda df: df.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
        assert sorted(map(tuple, tally(out))) == sorted(map(tuple, tally(plain)))
        return
    assert out.columns == wide.columns and out.schema == wide.schema
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted((r.doc_id, r.text) for r in plain.collect())
    wrong = [F.col(f"`{c}`") != F.col("doc_id") * 100 + i for i, c in enumerate(CLASHING)]
    assert out.where(F.greatest(*[w.cast("int") for w in wrong]) > 0).count() == 0
