"""Exact top-k search by inner product: columnar branch and bound.

Candidates are cut into blocks that are stored dimension by dimension. A query accumulates its scores one block of dimensions after
another over all candidates still alive. What the remaining dimensions can add is at most the product of the two remaining
norms, so a candidate whose best case stays below the k-th best worst case is dropped and the survivors are compacted. The
queries are cut into blocks as well; every pair of blocks is one task group of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptloom.storage import materialise

FOUND = "query long, query_row long, vec_id long, score long"


def top_of_block(columns: np.ndarray, rows: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, width: int,
                 rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the best ``k`` of a block for one query. ``columns`` is dimensions x rows, ``rest`` the candidates' norms from each
    block of dimensions on; ``own`` is the query's row, which is no candidate."""
    alive = np.flatnonzero(rows != own)
    score = np.zeros(len(alive), columns.dtype)
    tails = np.sqrt(np.add.reduceat((query.astype(float) ** 2), np.arange(0, len(query), width))[::-1].cumsum()[::-1])
    for b, start in enumerate(range(0, len(query), width)):
        part = columns[start : start + width]
        part = part if len(alive) == columns.shape[1] else part[:, alive]
        score = score + query[start : start + width] @ part
        if len(alive) <= k or start + width >= len(query):
            continue
        # The bound is rounded up by more than its floating point error.
        slack = tails[b + 1] * rest[b + 1, alive] * (1 + 1e-9) + 1
        worst = np.partition(score - slack, len(alive) - k)[len(alive) - k]
        keep = score + slack >= worst
        if not keep.all():
            alive, score = alive[keep], score[keep]
    order = np.lexsort((ids[alive], -score))[:k]
    return ids[alive[order]], score[order].astype(np.int64)


def _searched(k: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        left, right = (table.filter(pc.equal(table.column("_asks"), asks)) for asks in (False, True))
        out: tuple[list, ...] = ([], [], [], [])
        if left.num_rows and right.num_rows:
            rows, ids = (left.column(c).to_numpy() for c in ("_row", "_id"))
            columns, queries = _matrix(left), _matrix(right)
            size = max(len(columns[0]), len(queries[0]))
            columns, queries = (np.pad(x, ((0, 0), (0, size - x.shape[1]))) for x in (columns, queries))
            # Doubles add integers exactly as long as no sum can pass 2^53.
            largest = np.abs(columns.astype(float)).max(initial=0) * np.abs(queries.astype(float)).max(initial=0) * max(size, 1)
            kind = np.float64 if largest < 2**52 else np.int64
            columns, queries = np.ascontiguousarray(columns.T.astype(kind)), queries.astype(kind)
            squares = np.add.reduceat(columns.astype(float) ** 2, np.arange(0, size, width)) if size else np.zeros((1, len(ids)))
            rest = np.sqrt(squares[::-1].cumsum(axis=0)[::-1])
            for row, name, query in zip(right.column("_row").to_pylist(), right.column("_id").to_pylist(), queries):
                found, score = top_of_block(columns, rows, ids, query, row, k, width, rest)
                out[0].extend([name] * len(found))
                out[1].extend([row] * len(found))
                out[2].extend(found.tolist())
                out[3].extend(score.tolist())
        return pa.table([pa.array(x, pa.int64()) for x in out], ["query", "query_row", "vec_id", "score"])
    return run


def _matrix(table: pa.Table) -> np.ndarray:
    """Rows of a list column as one array; shorter lists are filled with zeros."""
    lists = table.column("_x").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
    if not len(sizes) or (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1)
    out = np.zeros((len(sizes), sizes.max()), np.int64)
    out[np.arange(sizes.max()) < sizes[:, None]] = flat
    return out


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(_row, _id, _x) of the usable vectors, with every component as floor(scale * component)."""
    values = F.col(embedding).cast("array<double>")
    usable = F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    kept = vectors.select(F.col(vec_id).cast("long").alias("_id"), values.alias("_v"), usable.alias("_ok")).filter("_ok")
    return kept.select(F.monotonically_increasing_id().alias("_row"), "_id", F.transform("_v", lambda x: F.floor(x * scale)).alias("_x"))


def search(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256,
           block: int = 4096, query_block: int = 2048, width: int = 8) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of every query row over all other rows, ties to the smaller id.

    ``is_query`` is a condition on the column ``_id``. Null vectors, vectors with a null or non-finite component and rows without an id take
    no part; vectors of other lengths count as filled with zeros; an empty vector scores 0. Repeated rows are rows of their own: a copy of the query's row is a candidate, and
    repeated query rows give their results twice. With fewer candidates than ``k`` all are returned; no vectors give no rows. Sums must fit 64-bit integers. Other
    columns are not read.
    """
    stored = materialise(quantised(vectors, vec_id, embedding, scale), "vectors")
    queries = stored.filter(is_query)
    total, asked = stored.count(), queries.count()
    parts, query_parts = max(1, -(-total // block)), max(1, -(-asked // query_block))
    spread = lambda n: F.pmod(F.xxhash64("_row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # One table of candidates and queries, since both sides of a cogroup would carry the same columns.
    left = stored.select("_row", "_id", "_x", spread(parts).alias("c"), each(query_parts).alias("q"), F.lit(False).alias("_asks"))
    right = queries.select("_row", "_id", "_x", each(parts).alias("c"), spread(query_parts).alias("q"), F.lit(True).alias("_asks"))
    found = left.union(right).groupBy("c", "q").applyInArrow(_searched(k, width), FOUND)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
