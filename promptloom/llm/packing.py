"""Packing: vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

Every task packs the documents of its own partition, so nothing is shuffled and a lost task repeats only itself. Documents give full
blocks first; what is left of them waits in a window of bounded size. A sequence is filled by the dot-product heuristic: of the
waiting pieces that fit under all limits, the one with the largest weighted product of its demands and what is left of the limits.
When none fits, one is cut to fill the rest. A sequence that cannot be filled is cut back to a power of two, so none needs padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.llm.tokens import encoder

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, loss_tokens long"
# Sequence numbers of a task start at its partition number times this.
PER_TASK = 1 << 36
PIECES_AT_ONCE = 2048  # of at most Limits.tokens ids each


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


class Packer:
    """Packs documents that are added one by one; ``rows`` holds (doc, start, stop, loss, sequence, offset)."""

    def __init__(self, limits: Limits, window: int):
        self.limits, self.window, self.rows, self.sequence = limits, window, [], 0
        self.docs: list = []
        self.items: list[tuple[int, int, int, int]] = []

    def loss(self, start: int, stop: int, free: int) -> int:
        return max(0, stop - max(start, free))

    def reach(self, start: int, stop: int, free: int, tokens: int, loss: int) -> int:
        """The furthest end of a piece from ``start`` under both limits."""
        return min(stop, start + tokens, max(start, free) + loss)

    def add(self, doc: int, n: int, free: int) -> None:
        """``free``: how many of the document's first ids bear no loss."""
        start, room = 0, self.limits
        while n - start >= room.tokens and self.reach(start, n, free, room.tokens, room.loss) == start + room.tokens:
            self.rows.append((doc, start, start + room.tokens, self.loss(start, start + room.tokens, free), self.sequence, 0))
            self.sequence += 1
            start += room.tokens
        if start < n:
            self.items.append((doc, start, n, free))

    def pack(self, all_of_it: bool) -> None:
        """Fill sequences from the window; unless at the end, only while it holds plenty to choose from."""
        if not self.items or (not all_of_it and len(self.items) < self.window):
            return
        doc, start, stop, free = (list(x) for x in zip(*self.items))
        length = np.array(stop) - np.array(start)
        loss = np.array([self.loss(a, b, f) for a, b, f in zip(start, stop, free)])
        alive, left, keep = np.ones(len(doc), bool), len(doc), 0 if all_of_it else self.window // 2
        limit = self.limits
        # Demands are compared as shares of their limits, each weighted by the mean demand of what waits.
        weight = np.array([length.mean() / limit.tokens, 1 / limit.segments, max(loss.mean(), 1e-9) / limit.loss])
        while left > keep:
            tokens, segments, losses, chosen = limit.tokens, limit.segments, limit.loss, []
            while left and tokens and segments:
                fits = alive & (length <= tokens) & (loss <= losses)
                if segments == 1:
                    fits &= length == tokens
                if fits.any():
                    score = (weight[0] * tokens / limit.tokens**2) * length + (weight[2] * losses / limit.loss**2) * loss
                    score += weight[1] * segments / limit.segments**2
                    i = int(np.argmax(np.where(fits, score, -1.0)))
                    end = stop[i]
                else:
                    i = int(np.argmax(np.where(alive, length, -1)))
                    end = self.reach(start[i], stop[i], free[i], tokens, losses)
                    if end <= start[i]:
                        break
                piece = self.loss(start[i], end, free[i])
                chosen.append((i, start[i], end))
                tokens, segments, losses = tokens - (end - start[i]), segments - 1, losses - piece
                start[i] = end
                length[i], loss[i] = stop[i] - end, self.loss(end, stop[i], free[i])
                if end == stop[i]:
                    alive[i] = False
                    left -= 1
            self._close(chosen, limit.tokens - tokens, doc, free)
            # What was cut back goes on waiting as the beginning of its document's rest.
            for i, a, b in self.returned:
                if not alive[i]:
                    alive[i], left = True, left + 1
                start[i] = a
                length[i], loss[i] = stop[i] - a, self.loss(a, stop[i], free[i])
        self.items = [(doc[i], start[i], stop[i], free[i]) for i in np.flatnonzero(alive)]

    def _close(self, chosen, total: int, doc, free) -> None:
        size = total if total == self.limits.tokens else 1 << (total.bit_length() - 1)
        self.returned, offset = [], 0
        for i, a, b in chosen:
            end = min(b, a + size - offset)
            if end > a:
                self.rows.append((doc[i], a, end, self.loss(a, end, free[i]), self.sequence, offset))
                offset += end - a
            if end < b:
                self.returned.append((i, max(a, end), b))
        self.sequence += 1


def _packed(limits: Limits, window: int, paths) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base = encoder(*paths), TaskContext.get().partitionId() * PER_TASK
        packer = Packer(limits, window)
        # Of a document that waits, only its name, its length and the ids of its tail are kept.
        waiting: dict[int, tuple[int | None, int, int, np.ndarray]] = {}
        out: list[tuple] = []

        def settle(doc: int, name: int | None, tokens: np.ndarray) -> None:
            """Rows of a new document's full blocks leave with their ids; its tail waits."""
            tail = packer.items[-1][1] if packer.items and packer.items[-1][0] == doc else len(tokens)
            waiting[doc] = (name, len(tokens), 0, tokens)
            flush()
            if tail < len(tokens):
                waiting[doc] = (name, len(tokens), tail, tokens[tail:].copy())
            else:
                del waiting[doc]

        def flush() -> None:
            rows, packer.rows = packer.rows, []
            for d, a, b, loss, sequence, offset in rows:
                name, total, start, tokens = waiting[d]
                out.append((name, a, b - a, tokens[a - start : b - start].tobytes(), total, base + sequence, offset, loss))

        def emitted() -> pa.RecordBatch:
            columns = [list(x) for x in zip(*out)] if out else [[]] * 8
            out.clear()
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loss_tokens"])

        number = 0
        for batch in batches:
            for name, text, free in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                tokens = np.array([*encode(text.as_py()), 0], "<u4")
                packer.add(number, len(tokens), max(0, free or 0))
                settle(number, name, tokens)
                number += 1
                if len(packer.items) >= window:
                    packer.pack(False)
                    flush()
                    still = {item[0] for item in packer.items}
                    for d in [d for d in waiting if d not in still]:
                        del waiting[d]
                if len(out) >= PIECES_AT_ONCE:
                    yield emitted()
        packer.pack(True)
        flush()
        yield emitted()
    return run


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", limits: Limits = Limits(), free_tokens: Column | None = None,
         window: int = 2048, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, loss_tokens.

    A document is its ids followed by id 0; every id lies in exactly one piece. ``free_tokens`` says how many first ids bear no loss, such as
    those of an instruction; by default the first one, which nothing predicts. Sequences hold at most ``limits.tokens`` ids and are either full or a power of two long.
    Null and empty texts are the closing id alone. Repeated rows and null ids are documents like any other; no documents give no rows;
    other columns are not read. ``tokenizer`` and ``ranks`` are the paths of the vocabulary on the executors.
    """
    free = F.lit(1) if free_tokens is None else free_tokens
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"), free.cast("long").alias("_free"))
    return rows.mapInArrow(_packed(limits, window, (tokenizer, ranks)), PIECES)
