"""Packing of instruction data: conversations with prompts, under three limits that bind.

A conversation is rendered turn by turn; all up to the last assistant turn is the
prompt, whose tokens bear no loss.  ``packing.pack`` places the conversations by
the dot product of their demands (tokens, one segment, loss-bearing tokens) with
the room that is left.  With fewer segments and loss-bearing tokens than tokens
allowed, each limit closes sequences; ``closed_by`` tells which one did.

Defined cases: as in ``preference.conversations``: rows without a conversation id
are ignored, repeated rows count once, null roles are ``unknown`` and null texts
empty; a conversation without an assistant turn is all prompt; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import packing
from quarry.llm.common import saved, small_batches, utf8
from quarry.llm.preference import conversations, render


def examples(rows: DataFrame) -> DataFrame:
    """(conv_id, prompt, answer): the rendered turns before the last assistant turn, and from it on."""
    convs = conversations(rows)
    from_end = F.array_position(F.reverse(F.transform("turns", lambda t: t["role"] == "assistant")), True)
    n = F.when(from_end > 0, F.size("turns") - from_end).otherwise(F.size("turns")).cast("int")
    cut = convs.withColumn("n", n)
    return cut.select("conv_id", render(F.slice("turns", F.lit(1), F.col("n"))).alias("prompt"),
                      render(F.slice("turns", F.col("n") + 1, F.size("turns"))).alias("answer"))


def _lengths(batches: Iterable[pa.RecordBatch], tokenizer_file: str) -> Iterator[pa.RecordBatch]:
    tokens = packing._tokens(tokenizer_file)
    for batch in small_batches(batches, "prompt", 2 << 20):
        n = [len(ids) // 4 for ids in tokens.encode(utf8(batch.column(1)))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=[*batch.schema.names, "n_prompt"])


def pack_conversations(rows: DataFrame, tokenizer_file: str, *, max_tokens: int = 2048, max_segments: int = 8,
                       max_loss: int = 512) -> DataFrame:
    """Pieces of all conversations in packed sequences, as ``packing.pack`` gives them, and what closed each sequence.

    ``closed_by``: ``tokens``, ``segments`` or ``loss`` for the first limit reached in
    this order; ``rest`` if none was (the rest is too little or its task's last).
    """
    counted = examples(rows).mapInArrow(partial(_lengths, tokenizer_file=tokenizer_file),
                                        "conv_id long, prompt string, answer string, n_prompt long")
    whole = saved(counted.select("conv_id", F.concat("prompt", "answer").alias("text"), "n_prompt"), "examples")
    pieces = saved(packing.pack(whole, tokenizer_file, id_col="conv_id", prompt_col="n_prompt", max_tokens=max_tokens,
                                max_segments=max_segments, max_loss=max_loss), "pieces")
    sums = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("segments"),
                                             F.sum("loss_tokens").alias("loss"))
    closed = (F.when(F.col("tokens") == max_tokens, "tokens").when(F.col("segments") == max_segments, "segments")
              .when(F.col("loss") == max_loss, "loss").otherwise("rest"))
    return pieces.withColumnRenamed("doc_id", "conv_id").withColumnRenamed("doc_tokens", "conv_tokens").join(
        sums.select("sequence_id", closed.alias("closed_by")), "sequence_id")
