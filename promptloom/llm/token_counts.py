"""Token counts by section: whole documents are encoded once, and their tokens are attributed to sections by character spans.

A byte-level token is a run of the text's bytes, so running sums of token lengths map every token to its place. Sections are
sorted character spans; both lists are sorted, so the interval join of a document is a binary search per section edge. A token
that crosses an edge is allocated by one of four rules: ``first`` and ``last`` to the section of its first or last byte, ``most`` to the section with
most of its bytes (the earlier one of equals), ``split`` to each by its share of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.llm.tokens import encoder

RULES = ("first", "last", "most", "split")
ROWS = "doc_id long, section int, start long, stop long, n_tokens double, n_crossing long"
SECTIONS = "array<struct<start:int,stop:int>>"


def line_sections(text: str) -> np.ndarray:
    """Spans of the lines of a text in code points, each with its line break; they tile the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    cuts = np.flatnonzero(points == 10) + 1
    edges = np.unique(np.concatenate([[0], cuts, [len(points)]]))
    return np.stack([edges[:-1], edges[1:]], 1)


def attribute(ends: np.ndarray, starts: np.ndarray, edges: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens per section. ``starts`` and ``ends`` are the tokens' bytes, ``edges`` rows of (start, stop) in bytes,
    sorted and apart. Tokens outside all sections go to one more section at the end."""
    n = len(edges)
    # Make the gaps between sections into sections too, so that edges tile everything.
    cuts = np.concatenate([edges.ravel(), [np.iinfo(np.int64).max]]) if n else np.array([np.iinfo(np.int64).max])
    owner = np.where(np.arange(2 * n + 1) % 2 == 1, np.arange(2 * n + 1) // 2, n)  # gap, section, gap, ...
    at = lambda x: owner[np.searchsorted(cuts, x, "right")]
    first, last = at(starts), at(ends - 1)
    tokens, crossing = np.zeros(n + 1), np.zeros(n + 1, np.int64)
    slot_first, slot_last = np.searchsorted(cuts, starts, "right"), np.searchsorted(cuts, ends - 1, "right")
    inside = (slot_first == slot_last) | (first == last) & (slot_last - slot_first < 2)
    np.add.at(tokens, first[inside], 1)
    for k in np.flatnonzero(~inside):
        shares: dict[int, int] = {}
        low = int(starts[k])
        for slot in range(slot_first[k], slot_last[k] + 1):
            high = min(int(cuts[slot]), int(ends[k]))
            if high > low:
                shares[int(owner[slot])] = shares.get(int(owner[slot]), 0) + high - low
            low = max(low, high)
        for section in shares:
            crossing[section] += len(shares) > 1
        total = int(ends[k] - starts[k])
        if rule == "split":
            for section, share in shares.items():
                tokens[section] += share / total
        else:
            named = {"first": int(first[k]), "last": int(last[k])}
            tokens[named[rule] if rule in named else max(shares, key=lambda s: (shares[s], -s))] += 1
    return tokens, crossing


def _counted(rule: str, paths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*paths)
        lengths = np.array([len(p) for p in encode.pieces], np.int64)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            given = batch.column(2) if batch.num_columns > 2 else [None] * batch.num_rows
            for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), given):
                text = text.as_py()
                if not text:
                    continue
                if spans is None:
                    edges = line_sections(text)
                else:
                    edges = np.array([(s["start"], s["stop"]) for s in spans.as_py() or []], np.int64).reshape(-1, 2)
                size = len(edges)
                ends = np.cumsum(lengths[encode(text)])
                marks = edges if text.isascii() else _byte_places(text)[edges]
                tokens, crossing = attribute(ends, ends - np.diff(ends, prepend=0), marks, rule)
                outside = tokens[-1] > 0
                n = size + int(outside)
                out[0] += [doc] * n
                out[1] += [*range(size), -1][:n] if outside else range(size)
                out[2] += [*edges[:, 0].tolist(), None][:n]
                out[3] += [*edges[:, 1].tolist(), None][:n]
                out[4] += tokens[:n].tolist()
                out[5] += crossing[:n].tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64()))
            ], ["doc_id", "section", "start", "stop", "n_tokens", "n_crossing"])
    return run


def _byte_places(text: str) -> np.ndarray:
    """Byte place of every code point, and of the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(width)])


def count(docs: DataFrame, sections: Column | None = None, rule: str = "first", text: str = "text", doc_id: str = "doc_id",
          tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """One row per document and section: doc_id, section (from 0), start, stop (code points), n_tokens, n_crossing.

    ``sections`` is a column of sorted, separate spans; lines by default. Tokens outside all sections are a row with section -1 and null
    edges. Null and empty texts have no tokens and no rows, a null list counts as empty, sections without a token of their own stay with 0. Repeated rows and
    null ids are counted like any other; other columns are not read. Counts of a document sum to its tokens under every rule.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    given = [] if sections is None else [sections.cast(SECTIONS).alias("_sections")]
    return docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"), *given).mapInArrow(_counted(rule, (tokenizer, ranks)), ROWS)
