"""Vector bin packing of examples into fixed-length training sequences.

Every example is a run of token ids of which the first ``prompt`` ones bear no
loss.  A sequence has three limits at once: tokens, segments (pieces) and
loss-bearing tokens.  The dot-product heuristic fills one sequence at a time:
among the pending examples that fit all three limits it takes the one whose
demand vector has the largest dot product with the room that is left, both
scaled by the limits.  When nothing fits, the example with the largest product
is cut to fill the room, so a closed sequence has no gap.

Work is per task: each task packs the rows it reads, holding a bounded window
of pending examples, so nothing is shuffled and no key can be hot.  A task that
is run again on the same input split gives the same rows.

Sequences that end before ``max_tokens`` (a limit other than tokens is reached,
or the task's input ends) are cut down to a power of two, which needs no
padding; the rest goes on into the next sequence.

Defined cases: null or empty text is the end-of-text id alone; a null id is
kept; repeated rows are packed one by one; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import small_batches, utf8, word_bounds, word_hashes

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long")
_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in PIECES.split(", ")])
_ID_BITS = 40  # sequence_id = task number << 40 | running number of the task


class Tokens(dict):
    """word (UTF-8) -> its ids as little-endian uint32.

    The vocabulary drops white space and never joins words across it, so a
    text's ids are its words' ids in a row.  It also lower-cases and never joins
    letters with the marks after them, so ``Word,`` is ``word`` and ``,``.  Words
    repeat, so their ids are kept (at most about ``limit`` words), and a batch
    looks up its distinct words only.
    """

    _MARKED = re.compile(rb"([A-Za-z\x80-\xff]+)([.,;:!?%*#&$]*)")

    def __init__(self, tokenizer_file: str, limit: int = 1_200_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.limit = limit
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        for piece, at in vocabulary.items():
            self.ends[at] = piece.endswith("</w>")

    def _letters(self, word: bytes) -> tuple[bytes, bytes] | None:
        """(lower-cased letters, marks) if the word is letters with or without marks after them."""
        m = self._MARKED.fullmatch(word)
        if m and (word.isascii() or m[1].decode().isalpha()):
            return m[1].lower(), m[2]
        return None

    def __missing__(self, word: bytes) -> bytes:
        ids = array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids

    def _learn_letters(self, words: list[bytes]) -> None:
        """Ids of words of letters only, each of which is one run of ids up to an id that ends a word."""
        for at in range(0, len(words), 5_000):
            part = words[at : at + 5_000]
            ids = np.array(self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
            stop = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(stop) != len(part):  # not so for some word: one by one
                for w in part:
                    self[w]
                continue
            raw, start = ids.tobytes(), 0
            for w, end in zip(part, stop.tolist()):
                self[w] = raw[start:end]
                start = end

    def _learn(self, words: list[bytes]) -> None:
        parts = {w: p for w in words if (p := self._letters(w))}
        self._learn_letters([w for w in {p[0] for p in parts.values()} if w not in self])
        for w, (letters, marks) in parts.items():
            self[w] = self[letters] + self[marks] if marks else self[letters]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self) > self.limit:
            self.clear()
        joined = b" ".join(texts)
        start, stop = word_bounds(joined)
        if not len(start):
            return [b""] * len(texts)
        _, first, inverse = np.unique(word_hashes(joined, start, stop), return_index=True, return_inverse=True)
        words = [joined[a:b] for a, b in zip(start[first].tolist(), stop[first].tolist())]
        self._learn([w for w in words if w not in self])
        ids = [self[w] for w in words]
        lengths = np.array([len(i) // 4 for i in ids])
        at = np.cumsum(lengths) - lengths
        counts = lengths[inverse]
        upto = np.concatenate([[0], np.cumsum(counts)])
        stream = np.frombuffer(b"".join(ids), "<u4")[np.repeat(at[inverse] - upto[:-1], counts) + np.arange(upto[-1])]
        ends = np.cumsum([len(t) + 1 for t in texts])
        cut = upto[np.searchsorted(start, ends)].tolist()
        return [stream[a:b].tobytes() for a, b in zip([0, *cut], cut)]


@cache
def _tokens(tokenizer_file: str) -> Tokens:
    """One tokenizer and store of words per Python worker, used by all its tasks."""
    return Tokens(tokenizer_file)


class Packer:
    """The dot-product heuristic over a bounded window of pending examples."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, window: int = 64):
        self.caps = np.array([max_tokens, max_segments, max_loss], np.float64)
        self.window = window
        self.pending: list[list] = []  # [key, start, end, prompt]
        self.closed: list[list[tuple]] = []  # sequences of (key, start, length, loss)

    @staticmethod
    def _loss(start: int, end: int, prompt: int) -> int:
        return max(0, end - max(start, prompt))

    def _cut(self, start: int, end: int, prompt: int, tokens: int, loss: int) -> int:
        """Largest end of a piece from ``start`` within ``tokens`` and ``loss``."""
        return min(end, start + tokens, max(start, prompt) + loss)

    def add(self, key, n: int, prompt: int = 0) -> None:
        """One more example of ``n`` ids; whole sequences are cut off it at once."""
        top, _, most_loss = (int(c) for c in self.caps)
        start = 0
        while n - start >= top:
            end = self._cut(start, n, prompt, top, most_loss)
            if end - start < top:
                break
            self.closed.append([(key, start, top, self._loss(start, end, prompt))])
            start = end
        if n > start:
            self.pending.append([key, start, n, prompt])
        while len(self.pending) >= self.window:
            self._fill()

    def finish(self) -> None:
        while self.pending:
            self._fill()

    def _fill(self) -> None:
        """Close one sequence from the pending examples."""
        items = self.pending
        need = np.array([(e - s, 1, self._loss(s, e, p)) for _, s, e, p in items], np.float64)
        size = need / self.caps
        left = np.ones(3)
        free = np.ones(len(items), bool)
        room = self.caps.copy()
        chosen: list[list] = []
        while room[0] >= 1 and room[1] >= 1 and free.any():
            product = size @ left
            fits = free & (need <= room).all(axis=1)
            if fits.any():
                k = int(np.argmax(np.where(fits, product, -1.0)))
                end = items[k][2]
            else:  # cut the best one to what is left
                cut = np.array([self._cut(s, e, p, int(room[0]), int(room[2])) - s for _, s, e, p in items])
                usable = free & (cut > 0)
                if not usable.any():
                    break
                k = int(np.argmax(np.where(usable, cut, -1)))
                end = items[k][1] + int(cut[k])
            key, start, whole, prompt = items[k]
            chosen.append([key, start, end, prompt, k])
            used = np.array([end - start, 1, self._loss(start, end, prompt)], np.float64)
            room -= used
            left = room / self.caps
            free[k] = False
            items[k] = [key, end, whole, prompt]
        total = sum(e - s for _, s, e, _, _ in chosen)
        if total < self.caps[0]:
            self._give_back(chosen, total - (1 << (total.bit_length() - 1)))
        self.closed.append([(key, s, e - s, self._loss(s, e, p)) for key, s, e, p, _ in chosen])
        self.pending = [x for x in items if x[2] > x[1]]

    def _give_back(self, chosen: list[list], excess: int) -> None:
        """Return the last ``excess`` ids of a short sequence to the pending ones."""
        while excess > 0:
            piece = chosen[-1]
            back = min(excess, piece[2] - piece[1])
            piece[2] -= back
            item = self.pending[piece[4]]
            item[1] -= back  # the item's rest began where the piece ended
            excess -= back
            if piece[2] == piece[1]:
                chosen.pop()


def _pack(batches: Iterable[pa.RecordBatch], tokenizer_file: str, end_id: int, limits: tuple) -> Iterator[pa.RecordBatch]:
    tokens = _tokens(tokenizer_file)
    packer = Packer(*limits)
    number = TaskContext.get().partitionId() << _ID_BITS
    end = np.array([end_id], "<u4").tobytes()
    held: dict[int, tuple] = {}  # row -> (doc_id, ids, ids not placed yet)
    row = 0

    def rows() -> pa.RecordBatch | None:
        nonlocal number
        out = []
        for sequence in packer.closed:
            offset = 0
            for key, start, length, loss in sequence:
                doc, ids, rest = held[key]
                out.append((doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]),
                            len(ids) // 4, number, offset, loss))
                offset += length
                if rest == length:
                    del held[key]
                else:
                    held[key] = (doc, ids, rest - length)
            number += 1
        packer.closed.clear()
        if out:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_ARROW)

    for batch in small_batches(batches, "text", 2 << 20):
        prompts = batch.column(2).to_pylist()
        for doc, ids, prompt in zip(batch.column(0).to_pylist(), tokens.encode(utf8(batch.column(1))), prompts):
            ids += end
            held[row] = (doc, ids, len(ids) // 4)
            packer.add(row, len(ids) // 4, min(prompt or 0, len(ids) // 4))
            row += 1
        if (done := rows()) is not None:
            yield done
    packer.finish()
    if (done := rows()) is not None:
        yield done


def pack(docs: DataFrame, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text",
         prompt_col: str | None = None, end_id: int = 1, max_tokens: int = 2048,
         max_segments: int = 256, max_loss: int | None = None) -> DataFrame:
    """Pieces of all examples with their place in the packed sequences.

    ``prompt_col`` holds the number of leading ids without loss (null or absent:
    every id bears loss).  ``max_loss`` defaults to ``max_tokens``.
    """
    prompt = F.col(prompt_col).cast("long") if prompt_col else F.lit(None).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       prompt.alias("prompt"))
    limits = (max_tokens, max_segments, max_loss or max_tokens)
    return rows.mapInArrow(partial(_pack, tokenizer_file=tokenizer_file, end_id=end_id, limits=limits), PIECES)
