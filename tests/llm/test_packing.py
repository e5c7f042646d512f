import pytest
from tokenizers import Tokenizer

from quarry.llm import packing
from quarry.llm.queries import op1_packing, tokenizer_file

from . import brute

ODD = [(1, None), (2, ""), (None, "Don's l'eau, été! <|endoftext|> a<|startoftext|>b"), (3, "ﬁ ａ, ß. İI ΣΑΣ x́, “a.” a.b,c! 12,5 %%%"),
       (4, "word, " * 5000), (5, "x" * 9000), (6, "same text"), (6, "same text"), (7, " \t\n\x0b\x0c\r "), (8, "漢字, กำ. ²³,\x1cz y")]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_file())


def test_whole_table_round_trip(spark, sf_small, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    brute.check_pieces(docs, op1_packing(spark, sf_small).collect(), tokenizer)


def test_odd_rows_and_clashing_columns(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in ODD], "doc_id long, text string, start int, sequence_id int")
    brute.check_pieces(ODD, packing.pack(docs, tokenizer_file()).collect(), tokenizer)
    assert packing.pack(docs.limit(0), tokenizer_file()).count() == 0


def test_all_limits_hold(spark, tokenizer):
    rows = [(i, "a b c d e f " * (1 + i % 7), 5 * (i % 3)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quiet int").repartition(2)
    got = packing.pack(docs, tokenizer_file(), prompt_col="quiet", max_tokens=64, max_segments=3, max_loss=48).collect()
    brute.check_pieces([r[:2] for r in rows], got, tokenizer, top=64, segments=3)
    loss = {}
    for p in got:
        quiet = 5 * (p.doc_id % 3)
        assert p.loss_tokens == max(0, p.start + p.length - max(p.start, min(quiet, p.doc_tokens)))
        loss[p.sequence_id] = loss.get(p.sequence_id, 0) + p.loss_tokens
    assert max(loss.values()) <= 48


def test_packer_fills_sequences():
    packer = packing.Packer(2048, 256, 2048)
    for k in range(500):
        packer.add(k, 1 + (k * 7919) % 3000)
    packer.finish()
    full = [s for s in packer.closed if sum(x[2] for x in s) == 2048]
    assert len(full) >= len(packer.closed) - 12
