"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test questions and answers.

A window is a run of words of an item. Every distinct word of the windows is a letter of its own, so a window is a short string and the
automaton steps once per word of a document, whatever the words' lengths. Words outside the benchmark share one letter that no window holds.
A text is folded byte by byte, which keeps its places, so hits map back to characters of the original.

The windows go to the tasks in a broadcast of at most ``most`` of them, after counting; a larger benchmark takes several automata, one pass
each, whose hits are united row by row. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.llm.words import fold, words_column
from promptloom.storage import materialise

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def windows(benchmark: DataFrame, item_id: str, columns: Sequence[str], width: int) -> DataFrame:
    """Distinct (item, window): runs of ``width`` words joined by spaces; a shorter text is one window, a text without words none."""
    words = F.explode(F.array(*[words_column(F.col(c).cast("string")) for c in columns]))
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), words.alias("w")).filter(F.size("w") > 0)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1))), lambda i: F.array_join(F.slice("w", i, width), " "))
    return rows.select("item", F.explode(runs).alias("window")).distinct()


class Automaton:
    """The windows of some items. ``find`` gives the hit words of a folded text as runs of word numbers, and the items."""

    def __init__(self, pairs: Sequence[tuple[str | None, str]]):
        from ahocorasick import Automaton as Machine

        self.letters: dict[bytes, str] = {}
        owners: dict[str, tuple[int, set]] = {}
        for item, window in pairs:
            words = window.encode().split(b" ")
            key = "".join([self.letters.setdefault(w, self._letter(len(self.letters) + 1)) for w in words])
            owners.setdefault(key, (len(words), set()))[1].add(item)
        self.machine = Machine()
        for key, owner in owners.items():
            self.machine.add_word(key, owner)
        self.machine.make_automaton()

    @staticmethod
    def _letter(n: int) -> str:
        return chr(n if n < 0xD800 else n + 0x800)  # code points without the surrogates; 0 stands for all other words

    def find(self, words: list[bytes], hit: np.ndarray | None) -> tuple[np.ndarray | None, set]:
        """``hit`` (by word, made when needed) with the words of occurring windows set, and the items these belong to."""
        letter, items = self.letters.get, set()
        if not self.letters:
            return hit, items
        for end, (length, owners) in self.machine.iter("".join([letter(w) or "\0" for w in words])):
            if hit is None:
                hit = np.zeros(len(words), bool)
            hit[end - length + 1 : end + 1] = True
            items |= owners
        return hit, items


def runs_of(hit: np.ndarray) -> np.ndarray:
    """(start, stop) of the runs of true values, as rows."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]]).astype(np.int8))).reshape(-1, 2)


def code_points(text: bytes, folded: bytes, runs: np.ndarray) -> np.ndarray:
    """Runs of word numbers as (start, stop) in code points of the text."""
    places = runs_of(np.frombuffer(folded, np.uint8) != 32)
    characters = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return np.stack([characters[places[runs[:, 0], 0]] - 1, characters[places[runs[:, 1] - 1, 1] - 1]], axis=1)


def _scanned(pairs: Broadcast, last: bool):
    """Adds one automaton's hits to ``hits`` (runs of word numbers; in the last pass of code points) and ``items``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(pairs.value)
        for batch in batches:
            n_words, n_hit, hits, items = [], [], [], []
            for value, old_hits, old_items in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                text = value.as_py() or b""
                folded = fold(text)
                words, hit = folded.split(), None
                if old_hits:
                    hit = np.zeros(len(words), bool)
                    for run_ in old_hits:
                        hit[run_["start"] : run_["stop"]] = True
                hit, found = automaton.find(words, hit)
                runs = np.zeros((0, 2), int) if hit is None else runs_of(hit)
                n_words.append(len(words))
                n_hit.append(0 if hit is None else int(hit.sum()))
                if last and len(runs):
                    runs = code_points(text, folded, runs)
                hits.append([{"start": a, "stop": b} for a, b in runs.tolist()])
                items.append(sorted((found - {None}).union(old_items)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1) if not last else pa.nulls(len(batch), pa.binary()), pa.array(hits, _SPANS), pa.array(items, pa.list_(pa.string())),
                 pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())], ["_row", "_text", "hits", "items", "n_words", "n_hit"])
    return run


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), item_id: str = "item_id",
         columns: Sequence[str] = ("text",), width: int = 10, most: int = 100_000) -> DataFrame:
    """One row per document: ``_row`` (struct of the columns in ``keep``), n_words, n_hit, hits (start, stop of hit passages in code points of
    the original text), items (ids of the items with an occurring window, sorted strings) and contaminated (n_hit > 0).

    A word is hit if it lies inside any occurrence of a window, overlapping ones included. ``columns`` name the item's texts, such as question and
    answer; windows do not cross from one to another. Null and empty texts, of documents or items, have no words: no hits, no windows. An item without an id
    marks words but is not named; rows that repeat an id are one item with the windows of all of them. Repeated documents give equal rows; no documents
    give no rows; no items hit nothing. Other columns are not read, and names cannot clash with those of ``_row``.
    """
    spark = docs.sparkSession
    pairs = materialise(windows(benchmark, item_id, columns, width), "windows")
    parts = max(1, -(-pairs.count() // most))
    none = [F.array().cast(T.ArrayType(SPAN)).alias("hits"), F.array().cast("array<string>").alias("items")]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    out = docs.select(row, F.col(text).cast("string").cast("binary").alias("_text"), *none)
    schema = out.schema.add("n_words", "long").add("n_hit", "long")
    for part in range(parts):
        own = pairs.filter(F.pmod(F.xxhash64("item", "window"), F.lit(parts)) == part)
        some = spark.sparkContext.broadcast([tuple(r) for r in own.select("item", "window").collect()])
        out = out.select("_row", "_text", "hits", "items").mapInArrow(_scanned(some, part == parts - 1), schema)
        if part < parts - 1:
            out = materialise(out, "hits")
    return out.select("_row", "n_words", "n_hit", "hits", "items", (F.col("n_hit") > 0).alias("contaminated"))
