"""Hard-negative mining: exact integer scores by matrix products in a residue number system, then windowed selection.

Every component is reduced modulo several small primes to a residue around zero. The residues' products are summed in float32, whose
integers are exact below 2^24; longer vectors are summed in runs that stay below it. Chinese remaindering (in mixed radix) then gives the signed
score, since the primes' product exceeds twice the largest score that the vectors' norms allow.

Anchors go to the tasks in blocks of bounded bytes; a pass over all rows meets each block, so rows are not shuffled or copied. A task keeps, for
every anchor of the block, the best few rows so far and emits only these; a window per anchor selects among the tasks' rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptloom.storage import materialise

EXACT = 1 << 24  # float32 holds every integer up to here
CELLS = 1 << 20  # scores held at once in a task
ROWS = 8192
MOST_ANCHORS = 16_384


def primes_for(largest: int, top: int = 1021) -> list[int]:
    """Primes from ``top`` downwards whose product exceeds twice ``largest`` by more than one."""
    out, product, p = [], 1, top
    while product <= 2 * largest + 1:
        if p < 3:
            raise ValueError("scores too large for the primes below the top")
        if all(p % d for d in range(2, math.isqrt(p) + 1)):
            out.append(p)
            product *= p
        p -= 1
    return out


def residues(values: np.ndarray, p: int) -> np.ndarray:
    """Integers as float32 residues between -p/2 and p/2."""
    return ((values + p // 2) % p - p // 2).astype(np.float32)


class Product:
    """Exact integer products of fixed rows with others. ``largest`` bounds the absolute value of every result."""

    def __init__(self, fixed: np.ndarray, largest: int):
        self.primes = primes_for(largest)
        self.fixed = [residues(fixed, p) for p in self.primes]

    def __call__(self, others: np.ndarray) -> np.ndarray:
        """fixed x others, in int64."""
        width, digits, scales, scale = others.shape[1], [], [], 1
        total = np.zeros((len(self.fixed[0]), len(others)), np.int64)
        for p, fixed in zip(self.primes, self.fixed):
            other, run = residues(others, p), max(1, EXACT // max(1, (p // 2) ** 2))
            rest = np.zeros(total.shape, np.int64)
            for at in range(0, width, run):
                rest += (fixed[:, at : at + run] @ other[:, at : at + run].T).astype(np.int64)
            # Mixed radix: the digit that a prime adds is what the value so far leaves over, divided by the primes so far.
            for digit, weight in zip(digits, scales):
                rest -= digit * (weight % p)
            digit = rest % p * pow(scale % p, -1, p) % p
            total += digit * np.uint64(scale % (1 << 64)).astype(np.int64)  # wraps around beyond 64 bits, as does the subtraction below
            digits.append(digit)
            scales.append(scale)
            scale *= p
        # Values above half the product of all primes stand for negative ones: compared digit by digit, the last one first.
        half, above, equal = scale // 2, np.zeros(total.shape, bool), np.ones(total.shape, bool)
        for digit, weight in zip(digits[::-1], scales[::-1]):
            limit, half = divmod(half, weight)
            above |= equal & (digit > limit)
            equal &= digit == limit
        return np.where(above, total - np.uint64(scale % (1 << 64)).astype(np.int64), total)


class Best:
    """The first ``k`` rows of every slot so far by (score descending, id, row)."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))
        self.floor = np.full(slots, np.iinfo(np.int64).min)  # a full slot's last score: less cannot enter

    def add(self, slot: np.ndarray, score: np.ndarray, name: np.ndarray, row: np.ndarray) -> None:
        slot, score, name, row = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, name), (self.row, row)))
        order = np.lexsort((row, name, -score, slot))
        ordered = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(ordered, ordered)
        keep, last = order[rank < self.k], order[rank == self.k - 1]
        self.slot, self.score, self.id, self.row = slot[keep], score[keep], name[keep], row[keep]
        self.floor[slot[last]] = score[last]


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` integers; shorter lists are filled with zeros."""
    sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _pass(anchors, width: int, largest: int, slots: int, k: int, fitting: Callable) -> Callable:
    """One pass over all rows against a block of anchors: ``fitting(block, score, label, row, floor)`` yields (slot, anchor, column) of rows that may enter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = anchors.value
        product, best, step = Product(block["x"], largest), Best(slots, k), max(1, min(ROWS, CELLS // max(1, len(block["row"]))))
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                row, name, label = (part.column(c).to_numpy() for c in range(3))
                score = product(_matrix(part.column(3), width))
                for slot, anchor, column in fitting(block, score, label, row, best.floor):
                    if len(slot):
                        best.add(slot, score[anchor, column], name[column], row[column])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (best.slot, best.row, best.id, best.score)], ["slot", "row", "name", "score"])
    return run


def same_label(block, score, label, row, floor):
    """Other rows of the anchor's label that reach the anchor's floor. A slot is an anchor."""
    fits = (score >= floor[:, None]) & (block["label"][:, None] == label) & (block["row"][:, None] != row)
    anchor, column = np.nonzero(fits)
    yield anchor, anchor, column


def in_band(block, score, label, row, floor):
    """Rows of other labels whose score is between the bounds of a positive. A slot is an anchor and a positive."""
    other = block["label"][:, None] != label
    for slots in block["rounds"]:  # the positives of one place in the ranking, at most one of each anchor
        anchor = block["slot_anchor"][slots]
        part, low = score[anchor], np.maximum(block["low"][slots], floor[slots])[:, None]
        at, column = np.nonzero((part >= low) & (part <= block["high"][slots][:, None]) & other[anchor])
        yield slots[at], anchor[at], column


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str, scale: int, relabel: Callable[[Column, Column], Column] | None) -> DataFrame:
    """(_row, _id, _label, _x) of the rows that take part, with every component as floor(scale * component)."""
    values, name, kind = F.col(embedding).cast("array<double>"), F.col(vec_id).cast("long"), F.col(label).cast("long")
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    kept = vectors.select(name.alias("_id"), (relabel(name, kind) if relabel else kind).alias("_label"), values.alias("_v"), whole.alias("_ok"))
    kept = kept.filter("_ok and _id is not null and _label is not null and _v is not null")
    return kept.select(F.monotonically_increasing_id().alias("_row"), "_id", "_label", F.transform("_v", lambda x: F.floor(x * scale)).alias("_x"))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80, vec_id: str = "vec_id",
         embedding: str = "embedding", label: str = "label", scale: int = 256, relabel: Callable[[Column, Column], Column] | None = None,
         anchor_bytes: int = 16 << 20) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows that meet ``is_anchor``, a condition on ``_id``. An anchor's positives are the first other rows of its label by inner product, ties to
    the smaller id. For each of them the first rows of other labels follow whose score is at most the positive's and at least ``percent`` hundredths
    of it; a positive with a score below 0 has none. ``relabel(id, label)`` may change labels first.
    Rows with a null id, label or vector, or a null or non-finite component, take no part. Shorter vectors count as filled with zeros. Repeated rows are rows of their
    own, as positives, negatives and anchors. No rows, one label only or no anchors give no rows. Squared norms must fit 62 bits. Other columns are not read.
    """
    spark = vectors.sparkSession
    stored = materialise(usable(vectors, vec_id, embedding, label, scale, relabel), "rows")
    squares = F.aggregate("_x", F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x.cast("decimal(19,0)") * x).cast("decimal(38,0)"))
    size, largest, asked = stored.agg(F.max(F.size("_x")), F.max(squares), F.count_if(is_anchor)).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not asked:
        return spark.createDataFrame([], schema)
    width, largest = int(size), int(largest)
    if largest >= 1 << 62:
        raise ValueError("scores do not fit 63 bits")
    blocks = -(-asked // max(1, min(MOST_ANCHORS, anchor_bytes // (8 * max(width, 1)))))
    out = []
    for b in range(blocks):
        own = stored.filter(is_anchor & (F.pmod(F.xxhash64("_row"), F.lit(blocks)) == b))
        # A hash of the row deals out blocks of about equal size, counted above.
        rows = own.orderBy("_row").toArrow()
        if not rows.num_rows:
            continue
        block = {n: rows.column(c).to_numpy() for n, c in (("row", "_row"), ("id", "_id"), ("label", "_label"))}
        block["x"] = _matrix(rows.column("_x").combine_chunks(), width)
        first = _selected(stored, block, width, largest, len(block["row"]), positives, same_label)
        near = first.orderBy("slot", "rank").toArrow()  # at most ``positives`` rows an anchor
        anchor, place, score = (near.column(c).to_numpy() for c in ("slot", "rank", "score"))
        block |= {"slot_anchor": anchor, "high": score, "low": -(-percent * score // 100), "rounds": [np.flatnonzero(place == r) for r in np.unique(place)]}
        found = _selected(stored, block, width, largest, len(anchor), negatives, in_band)
        slots = pa.table({"slot": np.arange(len(anchor)), "anchor_id": block["id"][anchor], "positive_id": near.column("name"), "positive_score": score})
        joined = found.join(F.broadcast(spark.createDataFrame(slots)), "slot")  # as many rows as the block has positives
        out.append(joined.select("anchor_id", "positive_id", "rank", F.col("name").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    return reduce(DataFrame.unionByName, out)


def _selected(stored: DataFrame, block: dict, width: int, largest: int, slots: int, k: int, fitting: Callable) -> DataFrame:
    """(slot, rank, row, name, score): the first ``k`` rows of every slot."""
    anchors = stored.sparkSession.sparkContext.broadcast(block)
    found = stored.select("_row", "_id", "_label", "_x").mapInArrow(
        _pass(anchors, width, largest, slots, k, fitting), "slot long, row long, name long, score long")
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), "name", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
