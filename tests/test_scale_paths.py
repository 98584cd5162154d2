"""The paths large or skewed inputs take give the same results as the small ones."""

import re
import tracemalloc
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from promptloom.operators import cells, classify, inference, positions, retrieval
from promptloom.plans import experiments
from promptloom.plans.specs import SPECS
from promptloom.plans.steps import chain
from promptloom.sources import datasets
from promptloom.storage import materialise
from promptloom.testing.doubles import json_model, letter_encoder
from tests.conftest import plan, rows

LIBRARY = Path(__file__).parent.parent / "promptloom"


def test_sliced_numbering_equals_a_window(spark):
    # One group holds a third of the rows, one key is null.
    df = spark.range(600).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 5).cast("string")).alias("g")
    ).repartition(5)
    want = df.withColumn("position", F.row_number().over(Window.partitionBy("g").orderBy("id")).cast("long"))
    assert rows(positions.number_rows(df, ["id"], ["g"], rows_per_task=37)) == rows(want)
    whole = df.withColumn("position", F.row_number().over(Window.orderBy("id")).cast("long"))
    assert rows(positions.number_rows(df, ["id"], rows_per_task=37)) == rows(whole)


def test_sliced_batches(spark):
    df = spark.range(100).select("id", F.lit("s").alias("source"))
    got = positions.assign_batches(df, 7, ["id"], ["source"], rows_per_task=10)
    assert rows(got.select("id", "batch")) == sorted([(i, i // 7) for i in range(100)], key=repr)


def test_class_lines_are_bounded(spark):
    df = spark.range(100).select(F.lit("c").alias("k"), F.col("id"), F.col("id").cast("string").alias("x"))
    lines = datasets.class_example_lines(df, "k", "x", "id", per_line=9, rows_per_task=10).orderBy("line_no").collect()
    assert [len(r.examples) for r in lines] == [9] * 11 + [1]
    assert [e for r in lines for e in r.examples] == [str(i) for i in range(100)]


def vectors(spark, n, dim=6, copies=0, seed=1):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim)).astype("float32")
    data[:copies] = data[0]
    return data, spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, embedding array<float>")


def brute(queries, index, k):
    out = []
    for qi, q in enumerate(queries.astype("float64")):
        d = ((q - index.astype("float64")) ** 2).sum(axis=1)
        for rank, xi in enumerate(np.lexsort((np.arange(len(index)), np.round(d, 12)))[:k], 1):
            out.append((qi, rank, int(xi), round(float(d[xi]), 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"block_rows": 17}, {"block_rows": 17, "cell_rows": 12}, {"cell_rows": 3}])
@pytest.mark.parametrize("copies", [0, 50])
def test_nearest_equals_brute_force(spark, options, copies):
    index, xdf = vectors(spark, 150, copies=copies)
    queries, qdf = vectors(spark, 40, seed=2)
    queries[:10] = index[0]
    qdf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(queries)], "id long, embedding array<float>")
    report = {}
    got = retrieval.nearest(qdf, xdf.withColumnRenamed("id", "xid"), 4, "id", "xid", report=report, **options)
    assert rows(got.withColumn("distance", F.round("distance", 6))) == brute(queries, index, 4)
    assert report["rounds"] == 1 or "cell_rows" in options


def test_clusters_far_apart_are_not_compared(spark):
    """Rounds end early and most pairs are never met where vectors form clusters."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8)) * 50
    index = (centres[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 8))).astype("float32")
    queries = (centres[rng.integers(0, 40, 100)] + rng.normal(size=(100, 8))).astype("float32")
    frame = lambda data, name: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], f"{name} long, embedding array<float>")
    report = {}
    got = retrieval.nearest(frame(queries, "id"), frame(index, "xid"), 4, "id", "xid", cell_rows=20, report=report)
    assert rows(got.withColumn("distance", F.round("distance", 6))) == brute(queries, index, 4)
    assert report["pairs"] < 2000 * 100 / 5


def test_nearest_with_fewer_rows_than_k_and_null_vectors(spark):
    index = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [3.0, 4.0]), ("c", None)], "split_id string, embedding array<float>")
    queries = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "query_id int, embedding array<float>")
    for options in ({}, {"cell_rows": 1}):
        assert rows(retrieval.nearest(queries, index, 5, **options)) == [(1, 1, "a", 0.0), (1, 2, "b", 25.0)]
    empty = index.filter("split_id = 'z'")
    assert rows(retrieval.nearest(queries, empty, 5)) == []


def test_nearest_rejects_ragged_vectors(spark):
    index = spark.createDataFrame([("a", [0.0]), ("b", [3.0, 4.0])], "split_id string, embedding array<float>")
    queries = spark.createDataFrame([(1, [0.0])], "query_id int, embedding array<float>")
    with pytest.raises(ValueError, match="length"):
        retrieval.nearest(queries, index)


def test_ties_go_to_the_lower_id(spark):
    index = spark.createDataFrame([(i, [1.0, 1.0]) for i in (9, 3, 7, 1)], "split_id int, embedding array<float>")
    queries = spark.createDataFrame([(1, [0.0, 0.0])], "query_id int, embedding array<float>")
    for options in ({}, {"block_rows": 1}, {"cell_rows": 1, "block_rows": 2}):
        assert [r[2] for r in rows(retrieval.nearest(queries, index, 2, **options), "rank")] == [1, 3]


def test_a_query_is_sent_once_to_a_group_of_cells(spark, monkeypatch):
    """Queries that visit every cell meet each row in few blocks, and find what a plain search finds."""
    rng = np.random.default_rng(3)
    vectors = rng.random((300, 6)).astype(np.float32)
    index = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "split_id int, embedding array<float>")
    asked = index.select(F.col("split_id").alias("query_id"), "embedding")
    sent, visit = [], cells._visit
    monkeypatch.setattr(cells, "_visit", lambda routed, *rest: sent.append(routed.select(F.explode("groups")).count()) or visit(routed, *rest))
    d = ((vectors[:, None].astype(float) - vectors[None].astype(float)) ** 2).sum(axis=2)
    want = sorted((q, r + 1, int(x)) for q in range(300) for r, x in enumerate(np.lexsort((np.arange(300), d[q]))[:4]))
    report = {}
    got = retrieval.nearest(asked, index, 4, cell_rows=4, report=report)
    assert sorted((r.query_id, r["rank"], r.split_id) for r in got.collect()) == want
    assert report["rounds"] > 1 and max(sent) <= 300
    # In a task, bounds tighten from cell to cell.
    monkeypatch.setattr(cells, "_FRESH_HITS", 1)
    every = pa.array(vectors.tolist(), pa.list_(pa.float32()))
    queries = pa.table({"_q": range(300), "_v": every, "_bound": pa.nulls(300, pa.float64()), "cells": [b"\xff\xc0"] * 300})
    found = cells.group_top_k(queries, pa.table({"_x": range(300), "_v": every, "_cell": [i % 10 for i in range(300)]}), 4, 10)
    ranked = found.sort_by([("_q", "ascending"), ("distance", "ascending"), ("_x", "ascending")])
    assert list(zip(ranked["_q"].to_pylist(), [1, 2, 3, 4] * 300, ranked["_x"].to_pylist())) == want
    assert cells.group_cells(np.array([3, 0, 9, 2, 2, 2]), 4).tolist() == [0, 0, 1, 2, 2, 3]


def test_steps_over_one_row_group_run_in_many_tasks(spark, monkeypatch):
    """Short rows in one task are spread before a model is asked."""
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = []
    monkeypatch.setattr(experiments, "materialise", lambda df, label: stored.append(materialise(df, label)) or stored[-1])
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
        rows_ = spark.range(2000).coalesce(1).withColumn("question", F.concat(F.lit("q"), F.col("id")))
        out = chain(rows_, [("first", SPECS["question_to_concept"])], json_model(concept=lambda p: "k"))
        assert len(out.inputFiles()) > 1 and out.count() == 2000
        asked = rows_.select(F.col("id").alias("request_id"), *[F.lit("s").alias(n) for n in ("schemas", "seed_questions", "question_task", "query_task")])
        experiments.sql_questions(asked, json_model(questions=lambda p: [], sql_query=lambda p: "SELECT 1"))
        assert len(stored[0].inputFiles()) > 1 and stored[0].count() == 2000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")


def test_an_append_stores_only_new_texts(spark, tmp_path, monkeypatch):
    """Known and repeated texts go through one aggregation; only what is new is written, once."""
    path, stored = str(tmp_path / "index"), []
    monkeypatch.setattr(retrieval, "materialise", lambda df, label: stored.append((label, materialise(df, label))) or stored[-1][1])
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "b", None])], "i int, t string")
    assert retrieval.append_to_index(texts, path, "t", letter_encoder, ["i"]) == 2
    assert retrieval.append_to_index(texts.union(spark.createDataFrame([(7, "c"), (7, "c")], texts.schema)), path, "t", letter_encoder, ["i"]) == 1
    assert [(label, df.count()) for label, df in stored] == [("append", 2), ("append", 1)]
    assert rows(retrieval.load_index(spark, path).select("split")) == [("a",), ("b",), ("c",)]


def test_an_encoder_task_holds_the_texts_of_a_call(spark):
    """The other texts of an Arrow batch are no Python objects, and nulls stay in place."""
    length = F.when(F.col("id") == 0, 20_001).otherwise(20_000)
    # A character beyond 16 bits makes each of a Python text take four bytes.
    padded = F.concat(F.rpad(F.col("id").cast("string"), length, "x"), F.lit("\U0001f600"))
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 != 9, padded).alias("text")).coalesce(1)

    def encoder():
        tracemalloc.start()

        def encode(batch):
            held = float(tracemalloc.get_traced_memory()[0])
            if max(map(len, batch)) > 20_001:  # the longest text comes last
                tracemalloc.stop()
            return [[float(x.rstrip("x\U0001f600")), held] for x in batch]

        return encode

    got = {r.id: r.embedding for r in inference.embed(df, encoder, budget=200_000).collect()}
    assert [got[i] and got[i][0] for i in range(1000)] == [None if i % 10 == 9 else float(i) for i in range(1000)]
    assert max(v[1] for v in got.values() if v) < 40e6  # the batch is 18 MB in Arrow, its texts 72 MB in Python


def test_distances_to_pivots_are_held_in_slices(monkeypatch):
    rng = np.random.default_rng(3)
    data, pivots = rng.normal(size=(3000, 8)).astype("float32"), rng.normal(size=(600, 8))
    asked, whole = [], cells.to_pivots(data, pivots)
    monkeypatch.setattr(cells, "to_pivots", lambda v, p, f=cells.to_pivots: asked.append(len(v)) or f(v, p))
    some = pd.Series([None, *data], dtype=object)
    places = cells.nearest_pivots(some, pivots)
    assert places[0].tolist() == [-1, *whole.argmin(axis=1)] and places[1] == pytest.approx([0.0, *whole.min(axis=1)])
    index = cells.Cells(None, pivots, np.full(600, 5), np.full(600, 2.0))
    route = cells._route(index, cells.group_cells(index.count, 500), 7, 0, 0).func
    routed = route(some[1:], pd.Series(np.nan, range(3000)))
    assert max(asked) <= 512 and sum(asked) == 6000 and routed.index.tolist() == list(range(3000))
    home = np.sort(np.argsort(whole, axis=1, kind="stable")[:, :2], axis=1)  # two cells hold seven rows
    assert [np.flatnonzero(row).tolist() for row in cells._bits(pa.array(routed["cells"]), 600)] == home.tolist()
    assert (routed["later"] == 598).all()


def test_top_n_windows_cut_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id", F.col("id").cast("string").alias("x"))
    assert "WindowGroupLimit" in plan(classify.few_shot(df, "k", "id", "x"))


def test_library_rules():
    """No local checkpoints or cross joins; what reaches the driver is bounded and listed here."""
    # Pivots, a row per cell or per prefix of ids, a row per case.
    allowed = {"operators/cells.py": 4, "operators/retrieval.py": 3, "operators/compare.py": 1, "operators/inference.py": 1}
    for path in LIBRARY.rglob("*.py"):
        code, name = path.read_text(), str(path.relative_to(LIBRARY))
        if name.startswith("llm/"):
            continue  # has a list of its own beside its tests
        assert not re.search(r"localCheckpoint|crossJoin|toPandas|\.rdd\b|toLocalIterator", code), name
        if not name.startswith("registry/"):
            assert len(re.findall(r"\.collect\(\)", code)) == allowed.get(name, 0), name


def test_broadcasts_are_bounded_by_bytes(spark, monkeypatch):
    wide = spark.range(20).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    hinted = lambda: "broadcast" in classify.small(wide)._jdf.queryExecution().logical().toString().lower()
    assert hinted() and classify.small(wide.limit(0)).count() == 0
    monkeypatch.setattr(classify, "MAX_BROADCAST_BYTES", 10_000)
    assert not hinted()
