"""Near-duplicate documents: circulant MinHash, banding, and exact Jaccard verification.

Two permutations make all coordinates of a signature. The first, a bijection of the 64-bit shingle codes, places every shingle of a
text on a circle. The second is a permutation of the circle; coordinate k is the minimum over the text's places of the second
permutation read k steps further on. All coordinates of a shingle are therefore one contiguous slice of one table.

Texts with equal shingle sets form a class, so copies cost one row. Classes that share a band are candidates. Every round pairs the
members of a bucket with one pivot of another component, tests the pairs on their full shingle sets and merges what is linked; pairs
within a component need no test any more. What is still apart after these rounds is paired by common rare shingles, which no linked pair
lacks, so no candidate pair that could join two components goes untested, and a large group never yields all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptloom.llm.common import hold, release
from promptloom.llm.components import connected
from promptloom.storage import materialise

CIRCLE_BITS = 20
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                    0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class Codes(dict):
    """64-bit codes of words, remembered up to a bounded number of them."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_codes(text: str | None, codes: Codes, width: int) -> np.ndarray:
    """Sorted distinct codes of a text's shingles; A-Z count as a-z, words end at ASCII white space."""
    words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    n = min(width, len(words))
    if not n:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        total += each[k : len(each) - n + 1 + k] * _PLACES[k]
    return np.unique(mixed(total))


def signature(shingles: np.ndarray, circle: np.ndarray, block: int = 4096) -> np.ndarray:
    """All coordinates at once: the least of the table's slices at the shingles' places."""
    places = shingles >> np.uint64(64 - CIRCLE_BITS)
    out = circle[places[:block]].min(axis=0)
    for start in range(block, len(places), block):
        np.minimum(out, circle[places[start : start + block]].min(axis=0), out=out)
    return out


def _circle(coordinates: int, seed: int) -> np.ndarray:
    """Row p holds the second permutation at p, p + 1, ... around the circle, as a view of one table."""
    table = np.random.default_rng(seed).permutation(1 << CIRCLE_BITS).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[:coordinates]]), coordinates)


def _signed(bands: int, rows: int, width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, circle = Codes(), _circle(bands * rows, seed)
        powers = mixed(np.arange(1, rows + 1, dtype=np.uint64) + np.uint64(seed)) | np.uint64(1)
        numbers = mixed(np.arange(bands, dtype=np.uint64) + np.uint64(977))
        for batch in batches:
            counts, prints, found = [], [], []
            for text in batch.column(2):
                shingles = shingle_codes(text.as_py(), codes, width)
                counts.append(len(shingles))
                if not len(shingles):
                    prints.append(None)
                    found.append(None)
                    continue
                prints.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                bits = signature(shingles, circle).astype(np.uint64).reshape(bands, rows)
                found.append(mixed((bits * powers).sum(axis=1, dtype=np.uint64) + numbers).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(prints, pa.binary()), pa.array(found, pa.list_(pa.int64()))
            ], ["key", "doc_id", "n_shingles", "print", "bands"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            sets = [shingle_codes(t.as_py(), codes, width).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["rep", "shingles"])
    return run


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 4, percent: int = 80, bands: int = 40,
                    rows: int = 5, pivot_rounds: int = 3, seed: int = 11) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, kept).

    Documents whose distinct ``width``-word shingles have ``100 * |A and B| >= percent * |A or B|`` are linked; ``component_id`` is the
    smallest id reachable. A text with fewer words is one shingle; a null, empty or blank text has none and is linked with nothing.
    A pair at exactly 0.8 misses all bands with a probability of 1.3e-7. Rows without an id stand alone: component null, kept.
    A repeated id is judged row by row and by each row's own text. No documents give no rows. Other columns are not read.
    """
    rows_of = materialise(docs.select(
        F.monotonically_increasing_id().alias("_key"), F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text")), "rows")
    judged = _judged(rows_of, width, percent, bands, rows, pivot_rounds, seed)
    return judged.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _judged(keyed: DataFrame, width: int = 4, percent: int = 80, bands: int = 40, rows: int = 5, pivot_rounds: int = 3, seed: int = 11) -> DataFrame:
    """(key, doc_id, n_shingles, component_id, first) of stored rows (_key, _id, _text), whose keys are unique.

    A class goes by the key of its first row, the one with the smallest id and then the smallest key, because an id may come with several
    texts. ``first`` marks the first row of each component, and every row without an id or a word.
    """
    signed = materialise(keyed.select("_key", "_id", "_text").mapInArrow(
        _signed(bands, rows, width, seed), "key long, doc_id long, n_shingles long, print binary, bands array<long>"), "signatures")
    classes = materialise(signed.filter("print is not null and doc_id is not null").groupBy("print").agg(
        F.min(F.struct("doc_id", "key")).alias("_first")).select("print", "_first", F.col("_first.key").alias("rep")), "classes")
    members = _bucket_members(signed, classes)
    roots = _merge(keyed, members, width, percent, pivot_rounds)
    rooted = classes.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select("print", "_first", F.coalesce("root", "rep").alias("_root"))
    firsts = rooted.groupBy("_root").agg(F.min("_first").alias("_least"))
    placed = signed.drop("bands").join(rooted.join(firsts, "_root").select("print", "_least"), "print", "left")
    linked = F.col("doc_id").isNotNull() & F.col("_least").isNotNull()
    return placed.select(
        "key", "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_least.doc_id", "doc_id")).alias("component_id"),
        (~linked | F.col("key").eqNullSafe(F.col("_least.key"))).alias("first"))


def _bucket_members(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(bucket, rep, n) of the buckets that hold two classes or more."""
    reps = signed.withColumnRenamed("key", "rep").join(classes.select("rep"), "rep")
    in_bucket = reps.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = in_bucket.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("bucket")
    return materialise(in_bucket.join(shared, "bucket"), "buckets")


def _merge(keyed, members, width, percent, pivot_rounds) -> DataFrame:
    """(node, root) of the classes that share a bucket, after all candidate pairs that matter have been tested."""
    roots = materialise(members.select(F.col("rep").alias("node"), F.col("rep").alias("root")).distinct(), "roots")
    picked = keyed.select(F.col("_key").alias("rep"), "_text").join(
        roots.select(F.col("node").alias("rep")), "rep", "left_semi")
    sets = materialise(picked.select("rep", "_text").mapInArrow(_sets(width), "rep long, shingles array<long>"), "sets")
    tested = None
    for turn in range(pivot_rounds + 1):
        placed = members.join(roots.withColumnRenamed("node", "rep"), "rep")
        pairs = _pivot_pairs(placed, turn, percent) if turn < pivot_rounds else _other_pairs(placed, sets, percent)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = materialise(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        links = materialise(_linked(pairs, sets, percent), "links")
        if not links.isEmpty():
            roots = _contract(roots, links)
    return roots


def _sizes_allow(a: str, b: str, percent: int):
    """A set much smaller than the other cannot reach the threshold."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _pivot_pairs(placed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, where their components differ. The first round ranks all classes alike, so
    that the buckets of one group choose the same pivot and most pairs coincide; later ones rank anew in every bucket."""
    rank = F.struct(F.xxhash64("rep", F.lit(turn), *(["bucket"] if turn else [])).alias("h"), F.col("rep").alias("b"), F.col("n").alias("m"),
                    F.col("root").alias("other"))
    pivots = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(rank).alias("p")).filter("lo < hi")
    met = placed.join(pivots.select("bucket", "p.b", "p.m", "p.other"), "bucket")
    return met.filter((F.col("root") != F.col("other")) & _sizes_allow("n", "m", percent)).select(F.col("rep").alias("a"), "b")


def _other_pairs(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every pair of two components that can still be linked, of the classes in buckets that hold more than one component.

    With the shingles of a text in one order for all, the rarest first, two sets that reach the threshold share a shingle among the first
    (100 - percent) % of either, and one more. Copies that differ too much have shingles of their own there, so a large group gives few
    pairs. Where a shingle is common nonetheless, only members outside its largest component are paired with the others.
    """
    open_buckets = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("bucket")
    classes = placed.join(open_buckets, "bucket").select("rep", "root").distinct()
    shingles = materialise(sets.join(classes, "rep").select("rep", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("s")), "shingles")
    common = shingles.groupBy("s").agg(F.count("*").alias("f"))
    order = Window.partitionBy("rep").orderBy("f", "s")
    first = shingles.join(common, "s").withColumn("k", F.row_number().over(order))
    first = materialise(first.filter(f"k <= floor(n * {100 - percent} / 100) + 1 and f > 1").select("s", "rep", "root", "n", "k"), "prefixes")
    parts = first.groupBy("s", "root").agg(F.count("*").alias("size")).groupBy("s").agg(
        F.count("*").alias("parts"), F.max(F.struct("size", "root")).alias("most")).filter("parts > 1")
    shared = first.join(parts.select("s", F.col("most.root").alias("largest")), "s")
    apart = shared.filter("root != largest").select("s", F.col("rep").alias("a"), F.col("n").alias("m"), F.col("root").alias("other"), F.col("k").alias("j"))
    # At the first shingle that two sets share, what lies behind it in either must suffice for the threshold.
    reachable = (1 + F.least(F.col("n") - F.col("k"), F.col("m") - F.col("j"))) * (100 + percent) >= percent * (F.col("n") + F.col("m"))
    met = shared.join(apart, "s").filter((F.col("root") != F.col("other")) & _sizes_allow("n", "m", percent) & reachable)
    return met.select("a", F.col("rep").alias("b"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold, as edges (u, v)."""
    first = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a")
    both = first.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
    shared = both.select("a", "b", (F.size("x") + F.size("y")).alias("total"), F.size(F.array_intersect("x", "y")).alias("shared"))
    return shared.filter(100 * F.col("shared") >= percent * (F.col("total") - F.col("shared"))).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def _contract(roots: DataFrame, links: DataFrame) -> DataFrame:
    at = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
    edges = links.join(at("u"), "u").join(at("v"), "v").select(F.col("u_root").alias("u"), F.col("v_root").alias("v"))
    moved = connected(edges).select(F.col("node").alias("root"), F.col("root").alias("_to"))
    return materialise(roots.join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root")), "roots")


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents with one of each group of near copies, with their columns: the one with the group's smallest id.

    Of rows that repeat an id in one group, one stays; rows with one id in several groups are judged apart. Rows without an id all stay,
    and so do texts without a word, which are in no group.
    """
    keyed = materialise(hold(docs, _key=F.monotonically_increasing_id(), _id=F.col(doc_id).cast("long")), "rows")
    judged = _judged(keyed.withColumn("_text", F.col("_row").getField(text)), **options)
    gone = judged.filter("not first").select(F.col("key").alias("_key"))
    return release(keyed.join(gone, "_key", "left_anti"))
