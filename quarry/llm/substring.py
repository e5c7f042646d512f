"""Removal of repeated lines (or paragraphs) across and within documents.

Units are the lines of a text (or its paragraphs, split at blank lines) that
hold a word.  They are normalised (lower case, white space collapsed), and their
128-bit digests are grouped over the whole table.  Of equal units the earliest
one stays: the one in the document with the smallest id, at its first place
there.  All others are repeats.  Repeats of neighbouring units form a run; a run
is removed if it holds at least ``min_words`` words, so a stray short line that
recurs by chance or custom stays.  Spans keep the offsets (code points) of the
original text.

Each document sends one row per distinct unit; groups are reduced to their
smallest document by a partial aggregate and joined back, so a line that a third
of the documents share needs no task of its own.

Defined cases: null or empty text has no units; rows that share a doc_id count
as one document, so a unit first seen there stays in all of them; repeated rows
get the same spans; rows with a null id come after all others, in the order of
a hash of their text; an empty table gives no rows; other columns are kept by
``remove_spans`` and may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved, small_batches

NO_ID = 1 << 62
_UNITS = ("node long, text_key long, unit int, start int, length int, words int, d1 long, d2 long, again boolean")
_ARROW = pa.schema([("node", pa.int64()), ("text_key", pa.int64()), ("unit", pa.int32()), ("start", pa.int32()),
                    ("length", pa.int32()), ("words", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()),
                    ("again", pa.bool_())])
_BREAK = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")}


def units(text: str, unit: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, length, normalised words) of every unit with a word."""
    start = 0
    for stop, after in [*((m.start(), m.end()) for m in _BREAK[unit].finditer(text)), (len(text), len(text))]:
        words = text[start:stop].lower().split()
        if words:
            yield start, stop - start, words
        start = after


def _units(batches: Iterable[pa.RecordBatch], unit: str) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        rows = []
        for node, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            seen = set()
            for k, (start, length, words) in enumerate(units(text or "", unit)):
                d = xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))
                rows.append((node, key, k, start, length, len(words), d, d in seen))
                seen.add(d)
        if rows:
            cols = list(zip(*rows))
            d = np.frombuffer(b"".join(cols[6]), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip([*cols[:6], d[:, 0], d[:, 1], cols[7]], _ARROW)], schema=_ARROW)


def identity(id_col: str, text_col: str) -> list[Column]:
    """Columns node (the id, or a number above NO_ID from the text's hash) and text_key (that hash)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(text)
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID) + F.shiftrightunsigned(key, 2)).alias("node"), key.alias("text_key")]


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
                   min_words: int = 20) -> DataFrame:
    """One row per removed unit: node, text_key, unit, start, length, words, first_node, first_start."""
    named = docs.select(*identity(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    found = saved(named.mapInArrow(partial(_units, unit=unit), _UNITS), "units")
    first = found.where("NOT again").groupBy("d1", "d2").agg(
        F.min("node").alias("first_node"), F.count(F.lit(1)).alias("n"))
    inside = found.where("again").select("d1", "d2").distinct()
    shared = first.where("n > 1").select("d1", "d2", "first_node").unionByName(
        first.where("n = 1").join(inside, ["d1", "d2"], "left_semi").select("d1", "d2", "first_node"))
    repeats = (found.join(shared, ["d1", "d2"]).where("again OR node != first_node")
               .select("node", "text_key", "unit", "start", "length", "words", "first_node")
               .dropDuplicates(["node", "text_key", "unit"]))
    in_text = Window.partitionBy("node", "text_key").orderBy("unit")
    runs = (repeats.withColumn("gap", F.when(F.col("unit") - F.lag("unit").over(in_text) == 1, 0).otherwise(1))
            .withColumn("run", F.sum("gap").over(in_text))
            .withColumn("run_words", F.sum("words").over(Window.partitionBy("node", "text_key", "run"))))
    return runs.where(F.col("run_words") >= min_words).drop("gap", "run", "run_words")


def doc_id_of(node: str) -> Column:
    """The document id of a node (null for rows without one)."""
    return F.when(F.col(node) < NO_ID, F.col(node))


def _cut(batches: Iterable[pa.RecordBatch], text: str, spans: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        at_text, at_spans = batch.schema.get_field_index(text), batch.schema.get_field_index(spans)
        for value, cuts in zip(batch.column(at_text).to_pylist(), batch.column(at_spans).to_pylist()):
            if cuts:
                kept, at = [], 0
                for start, length in sorted((c["start"], c["length"]) for c in cuts):
                    kept.append(value[at:start])
                    whole = start == 0 or value[start - 1] == "\n"
                    at = start + length + (whole and value[start + length : start + length + 1] == "\n")
                value = "".join([*kept, value[at:]])
            out.append(value)
        cols = batch.columns
        cols[at_text] = pa.array(out, batch.schema.field(at_text).type)
        yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)


def remove_spans(docs: DataFrame, spans: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 spans_col: str = "__spans") -> DataFrame:
    """``docs`` without the spans (and the line break after one that begins its line); columns unchanged, rows all kept.

    A column ``__spans`` (array of start, length) tells which rows were cut.
    """
    per_doc = spans.groupBy(F.col("node").alias("__node"), F.col("text_key").alias("__key")).agg(
        F.collect_list(F.struct("start", "length")).alias(spans_col))  # at most one entry per line of the text
    node, key = identity(id_col, text_col)
    tagged = docs.withColumns({"__node": node, "__key": key})
    joined = tagged.join(per_doc, ["__node", "__key"], "left").drop("__node", "__key")
    return joined.mapInArrow(partial(_cut, text=text_col, spans=spans_col), joined.schema)
