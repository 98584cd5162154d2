"""Nearest neighbours over an embedding table, stored indexes and prompt augmentation.

A stored index keeps its rows in folders by cell, and its ids in folders by prefix. A search reads the folders of the cells that its queries visit, an
append the ids of the prefixes it holds, so neither reads the index whole. Appends are numbered; the manifest of a number names
the state of every cell and is written last, so a half-written append is never seen and is written over by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptloom.functions.text import chunk_rows
from promptloom.operators import cells
from promptloom.operators.inference import embed
from promptloom.storage import drop_path, list_names, materialise

ROWS = "split_id string, split string, embedding array<float>, _far double, batch int, _cell int"
IDS = "split_id string, batch int, prefix string"
MANIFEST = "cell int, pivot array<double>, n long, radius double"


@dataclass(frozen=True)
class StoredIndex:
    """An index as of one append: ``rows`` reads what its manifest names, by cell."""

    path: str
    version: int
    rows: DataFrame
    pivots: np.ndarray
    count: np.ndarray
    radius: np.ndarray

    def cells(self) -> cells.Cells:
        return cells.Cells(self.rows.filter("_cell >= 0").select(F.col("split_id").alias("_x"), F.col("embedding").alias("_v"), "_cell"),
                           self.pivots, self.count, self.radius)


def nearest(queries: DataFrame, index: DataFrame | StoredIndex, k: int = 5, query_id: str = "query_id", index_id: str = "split_id",
            vector: str = "embedding", cell_rows: int = cells.CELL_ROWS, block_rows: int | None = None, report: dict | None = None) -> DataFrame:
    """The k index rows closest to each query: (query_id, rank, index_id, distance), rank from 1.

    Distance is squared L2 in double precision; ties go to the lower id. Rows without a vector do not
    take part; ids must be unique. A table is grouped into cells of about ``cell_rows`` first, a stored index is so already. ``report`` receives the number of
    rounds and of pairs compared.
    """
    return _nearest(queries, index, k, query_id, index_id, vector, cell_rows, block_rows, report).drop("_cell")


def _nearest(queries, index, k, query_id, index_id, vector, cell_rows=cells.CELL_ROWS, block_rows=None, report=None) -> DataFrame:
    q = queries.select(F.col(query_id).alias("_q"), F.col(vector).alias("_v")).filter(F.col("_v").isNotNull())
    if isinstance(index, StoredIndex):
        placed = index.cells()
    else:
        placed = cells.place(index.select(F.col(index_id).alias("_x"), F.col(vector).alias("_v")).filter(F.col("_v").isNotNull()), cell_rows)
    found = cells.search(q, placed, k, block_rows, report)
    return found.select(F.col("_q").alias(query_id), "rank", F.col("_x").alias(index_id), "distance", "_cell")


def index_rows(df: DataFrame, text: str, encoder: Callable, id_cols: Sequence[str] = ()) -> DataFrame:
    """Index table (split_id, split, embedding). The id is a hash of the id columns and the text, so a
    rerun or a retried task gives a row the same id."""
    return embed(_keyed(df, text, id_cols), encoder, "split")


def _keyed(df: DataFrame, text: str, id_cols: Sequence[str]) -> DataFrame:
    identity = F.sha2(F.to_json(F.struct(*id_cols, F.col(text).alias("_text"))), 256)
    return df.filter(F.col(text).isNotNull()).select(identity.alias("split_id"), F.col(text).alias("split"))


def build_index(documents: DataFrame, encoder: Callable, text: str = "text", id_cols: Sequence[str] = ("doc_id",),
                chunk_size: int = 1024, overlap: int = 0) -> DataFrame:
    """Chunk documents and embed the chunks."""
    chunks = chunk_rows(documents, text, list(id_cols), chunk_size, overlap)
    return index_rows(chunks, "chunk", encoder, [*id_cols, "chunk_no"])


def save_index(index: DataFrame, path: str, cell_rows: int = cells.CELL_ROWS, id_digits: int = 1) -> None:
    """Store an index table, in place of what the path holds, around pivots of its own. To give a grown index new pivots, save what
    ``load_index`` gives at another path. ``id_digits`` is the length of the prefixes that ids are kept by: each hex digit more splits their folders by 16, so that
    small appends read less of them."""
    _save(materialise(index.select("split_id", "split", "embedding"), "index"), path, cell_rows, id_digits)


def _save(stored: DataFrame, path: str, cell_rows: int = cells.CELL_ROWS, id_digits: int = 1) -> None:
    drop_path(stored.sparkSession, f"{path}/manifest")
    known = stored.filter("embedding is not null").select(F.col("embedding").alias("_v"))
    _write_batch(stored, path, 0, cells.fit_pivots(known, known.count(), cell_rows), None, id_digits)


def _write_batch(fresh: DataFrame, path: str, number: int, pivots: np.ndarray, before: StoredIndex | None, id_digits: int) -> None:
    spark = fresh.sparkSession
    rows = cells.assigned(fresh.withColumn("_v", F.col("embedding")), pivots).drop("_v")
    # Adaptive execution splits a folder that holds most rows and lets small ones share a task.
    rows.hint("rebalance", "_cell").write.mode("overwrite").partitionBy("_cell").parquet(f"{path}/rows/batch={number}")
    ids = fresh.select("split_id", F.substring("split_id", 1, id_digits).alias("prefix"))
    # Prefixes of a hash are about equally frequent.
    ids.repartition(spark.sparkContext.defaultParallelism, "prefix").write.mode("overwrite").partitionBy("prefix").parquet(f"{path}/ids/batch={number}")
    written = spark.read.schema(ROWS).parquet(f"{path}/rows").filter(F.col("batch") == number)
    count, radius = cells.cell_sizes(written, len(pivots))
    if before is not None:
        count, radius = count + before.count, np.maximum(radius, before.radius)
    state = [(c, [float(x) for x in pivots[c]], int(count[c]), float(radius[c])) for c in range(len(pivots))]
    spark.createDataFrame(state, MANIFEST).coalesce(1).write.mode("error").parquet(f"{path}/manifest/version={number}")


def open_index(spark: SparkSession, path: str) -> StoredIndex | None:
    """The newest complete state of a stored index, ready to be searched; None where there is none."""
    versions = [int(n.removeprefix("version=")) for n in list_names(spark, f"{path}/manifest") if n.startswith("version=")]
    versions = [v for v in sorted(versions) if "_SUCCESS" in list_names(spark, f"{path}/manifest/version={v}")]
    if not versions:
        return None
    state = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/version={versions[-1]}").orderBy("cell").collect()  # a row per cell
    rows = spark.read.schema(ROWS).parquet(f"{path}/rows").filter(F.col("batch") <= versions[-1])
    pivots = np.array([r.pivot for r in state], dtype=np.float64).reshape(len(state), -1) if state else np.zeros((0, 0))
    return StoredIndex(path, versions[-1], rows, pivots, np.array([r.n for r in state], dtype=np.int64), np.array([r.radius for r in state]))


def load_index(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a stored index as (split_id, split, embedding)."""
    index = open_index(spark, path)
    if index is None:
        raise FileNotFoundError(f"no index at {path}")
    return index.rows.select("split_id", "split", "embedding")


def append_to_index(df: DataFrame, path: str, text: str, encoder: Callable, id_cols: Sequence[str]) -> int:
    """Append the texts whose id the index lacks, each once, and return how many. The index may not exist yet.

    Only ids with a prefix that the new texts have are read, and known texts never reach the encoder; new rows go to the cells of the stored pivots. One
    writer at a time: of two that append at once, the later one fails, as the number of its manifest is taken, and may run again.
    """
    spark = df.sparkSession
    index = open_index(spark, path)
    fresh, digits = _keyed(df, text, id_cols), _id_digits(spark, path)
    if index is None:
        fresh = fresh.dropDuplicates(["split_id"])
    else:
        prefixes = [r[0] for r in fresh.select(F.substring("split_id", 1, digits)).distinct().collect()]  # a row per folder
        known = spark.read.schema(IDS).parquet(f"{path}/ids").filter((F.col("batch") <= index.version) & F.col("prefix").isin(prefixes))
        # One shuffle brings the texts of an id together and with its entry in the index.
        both = fresh.withColumn("known", F.lit(False)).unionByName(known.select("split_id", F.lit(None).cast("string").alias("split"), F.lit(True).alias("known")))
        fresh = both.groupBy("split_id").agg(F.max("split").alias("split"), F.bool_or("known").alias("known")).filter("not known").drop("known")
    added = materialise(embed(fresh, encoder, "split"), "append")
    n = added.count()
    if index is None or not len(index.pivots):
        _save(added, path)
    elif n:
        _write_batch(added, path, index.version + 1, index.pivots, index, digits)
    return n


def _id_digits(spark: SparkSession, path: str) -> int:
    """How long the prefixes are that a stored index keeps its ids by; 1 where it has none."""
    names = [n for b in list_names(spark, f"{path}/ids") for n in list_names(spark, f"{path}/ids/{b}") if n.startswith("prefix=")]
    return len(names[0].removeprefix("prefix=")) if names else 1


def augment_prompts(prompts: DataFrame, hits: DataFrame, query_id: str = "query_id", prompt: str = "prompt",
                    split: str = "split", slot: str | None = None) -> DataFrame:
    """Join the retrieved texts with line breaks in rank order; append them, or put them in ``{slot}``.

    A query has at most k hits, so the collected list is bounded.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", F.col(split).alias("t"))))
    context = hits.groupBy(query_id).agg(F.array_join(F.transform(ranked, lambda h: h["t"]), "\n").alias("_context"))
    joined = prompts.join(context, query_id, "left")
    found = F.coalesce(F.col("_context"), F.lit(""))
    full = F.concat(F.col(prompt), found) if slot is None else F.replace(F.col(prompt), F.lit("{" + slot + "}"), found)
    return joined.withColumn(prompt, full).drop("_context")


def retrieve(prompts: DataFrame, index: DataFrame | StoredIndex, encoder: Callable, k: int = 3, query_id: str = "query_id",
             prompt: str = "prompt", **options) -> DataFrame:
    """Hits of each prompt with their texts: (query_id, rank, split_id, distance, split). Of a stored index, texts are read where there are hits."""
    embedded = materialise(embed(prompts.select(query_id, prompt), encoder, prompt).drop(prompt), "query-vectors")
    hits = _nearest(embedded, index, k, query_id, "split_id", "embedding", **options)
    if isinstance(index, StoredIndex):
        hits = materialise(hits, "hits")
        held = [r[0] for r in hits.select("_cell").distinct().collect()]  # a row per cell
        texts = index.rows.filter(F.col("_cell").isin(held)).select("split_id", "split")
    else:
        texts = index.select("split_id", "split")
    return hits.drop("_cell").join(texts, "split_id")


def rag_prompts(prompts: DataFrame, index: DataFrame | StoredIndex, encoder: Callable, k: int = 3, query_id: str = "query_id",
                prompt: str = "prompt", slot: str | None = None, **options) -> DataFrame:
    """Prompts with the k most similar splits added; ready for a model call. Pass a stored index."""
    return augment_prompts(prompts, retrieve(prompts, index, encoder, k, query_id, prompt, **options),
                           query_id, prompt, slot=slot)
