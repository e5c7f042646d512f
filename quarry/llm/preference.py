"""Preference formatting of conversations.

A pair is a chosen and a rejected conversation.  Their longest common prefix of
turns (same role and text) is rendered once as the prompt; the turns after it
are rendered as two completions.  A mask lists the loss-bearing spans of each
completion (start and length in code points): the assistant's texts with their
end marks, never the headers or other roles.

``preference_pairs`` makes the pairs: conversations that open with the same turn
answer the same request, the one with the most assistant text (ties: the
smallest id) is chosen, and each of the others is rejected against it.  Pairs
grow with the rows, not with the square of a group, and the group's best is
found by a partial aggregate, so a common first turn needs no task of its own.

Defined cases: rows without a conversation id are ignored; repeated rows count
once; two rows for one turn are ordered by role and text; null roles are shown
as ``unknown`` and null texts as empty; a conversation that shares its first
turn with no other is ``single``: its prompt ends before the last assistant turn
and there is no rejected side; one equal to the chosen one is ``same``, with
empty completions; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as an array of (turn, role, text)."""
    clean = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    return clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def preference_pairs(convs: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, kind) for the conversations that open alike; single ones have no rejected_id."""
    spoken = F.aggregate("turns", F.lit(0), lambda n, t: n + F.when(t["role"] == "assistant", F.length(t["text"])).otherwise(0))
    first = F.col("turns")[0]
    opened = convs.select("conv_id", F.md5(F.concat_ws("\x00", first["role"], first["text"])).alias("opening"), spoken.alias("spoken"))
    longest = opened.groupBy("opening").agg(F.max("spoken").alias("spoken"), F.count(F.lit(1)).alias("n"))
    best = opened.join(longest, ["opening", "spoken"]).groupBy("opening").agg(
        F.min("conv_id").alias("chosen_id"), F.max("n").alias("n"))
    with_best = opened.join(best, "opening")
    return with_best.where("n = 1 OR conv_id != chosen_id").select(
        "chosen_id", F.when(F.col("n") > 1, F.col("conv_id")).alias("rejected_id"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


_END = "<|end|>\n"


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(_END))), "")


def loss_mask(turns: Column) -> Column:
    """Array of (start, length): the assistant's texts and end marks in ``render(turns)``."""
    spans = F.array().cast("array<struct<start:int,length:int>>")

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(_head(t))
        size = F.length(t["text"]) + len(_END)
        span = F.array(F.struct(start.cast("int").alias("start"), size.cast("int").alias("length")))
        return F.struct((start + size).cast("int").alias("at"),
                        F.when(t["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), spans.alias("spans")), add, lambda s: s["spans"])


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns that are equal in role and text."""
    equal = F.zip_with(chosen, rejected, lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    at = F.array_position(equal, False)
    return F.when(at > 0, at - 1).otherwise(F.size(chosen)).cast("int")


def format_pairs(pairs: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per pair: ids, kind, n_prompt_turns, prompt, both completions and their masks."""
    chosen = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    rejected = convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r"))
    both = pairs.join(chosen, "chosen_id").join(rejected, "rejected_id", "left")
    from_end = F.array_position(F.reverse(F.transform("c", lambda t: t["role"] == "assistant")), True)
    own = F.when(from_end > 0, F.size("c") - from_end).otherwise(F.size("c")).cast("int")
    cut = both.withColumn("n_prompt_turns", F.when(F.col("r").isNull(), own).otherwise(common_turns(F.col("c"), F.col("r"))))
    n = F.col("n_prompt_turns")
    tails = cut.withColumns({"prompt_turns": F.slice("c", F.lit(1), n), "c": F.slice("c", n + 1, F.size("c")),
                             "r": F.slice("r", n + 1, F.size("r"))})
    kind = (F.when(F.col("rejected_id").isNull(), "single")
            .when((F.size("c") == 0) & (F.size("r") == 0), "same").otherwise("pair"))
    return tails.select(
        "chosen_id", "rejected_id", kind.alias("kind"), "n_prompt_turns", render(F.col("prompt_turns")).alias("prompt"),
        render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"),
        loss_mask(F.col("c")).alias("chosen_mask"), loss_mask(F.col("r")).alias("rejected_mask"))


def preference_examples(rows: DataFrame) -> DataFrame:
    """Paired masked completions of a conversation table (conv_id, turn, role, text)."""
    convs = saved(conversations(rows), "conversations")
    return format_pairs(preference_pairs(convs), convs)
