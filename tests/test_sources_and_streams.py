"""Files in and out, and streaming jobs with restarts."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from promptloom.operators import retrieval
from promptloom.sources import datasets, pairs, tables
from promptloom.streaming import jobs
from promptloom.testing.doubles import letter_encoder, refusing_model
from tests.conftest import rows


def test_jsonl_pairs(spark, tmp_path):
    path = tmp_path / "p.jsonl"
    path.write_text('{"q": "a", "r": "b"}\n{"q": "c"}\n{"q": "d", "r": null, "x": 1}\n')
    assert rows(pairs.load_pairs(spark, str(path), "q", "r")) == [("a", "b"), ("c", ""), ("d", "")]
    path.write_text('{"q": "a"}\n{"r": "b"}\n')
    with pytest.raises(PySparkException, match="record without key q"):
        pairs.load_pairs(spark, str(path), "q", "r").collect()


def test_csv_pairs(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('input,output\n"a ""x"", b",\n,c\n"two\nlines",d\n')
    assert rows(pairs.load_pairs(spark, str(path))) == [("", "c"), ('a "x", b', ""), ("two\nlines", "d")]
    with pytest.raises(ValueError, match="question"):
        pairs.load_pairs(spark, str(path), "question")
    with pytest.raises(ValueError, match="only .jsonl, .jsonlines and .csv"):
        pairs.load_pairs(spark, "x.txt")


def test_csv_by_many_tasks_equals_one_task(spark, tmp_path):
    """Values with line breaks, quotes, blank lines and carriage returns, over many small blocks and two files."""
    rng = random.Random(4)
    pieces = ["a", "é", '""', ",", "\n", "\n\n", " ", "long " * 9]
    value = lambda: '"' + "x" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) + '"'
    folder = tmp_path / "p.csv"
    folder.mkdir()
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n")):
        lines = [end if rng.random() < 0.05 else f"{value()},{rng.choice(['', 'plain', value()])}{end}" for _ in range(300)]
        (folder / name).write_text(f"input,output{end}" + "".join(lines), newline="")
    whole = spark.read.csv(str(folder), header=True, multiLine=True, escape='"').na.fill("")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1500", "40000", kept):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert rows(pairs.load_pairs(spark, str(folder))) == rows(whole), size
            blocks = spark.read.text(str(folder)).rdd.getNumPartitions()
            assert blocks > 10 or size != "1500"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_csv_lines_are_joined_before_they_are_stored(spark, tmp_path, monkeypatch):
    """A text of many lines is a few stored rows, and records come out whole however the lines are cut to pieces."""
    rng = random.Random(5)
    value = lambda: '"' + "".join(rng.choice(["a", '""', ",", "\n", "\r\n", "é"]) for _ in range(rng.randint(0, 40))) + '"'
    folder = tmp_path / "p.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('  \n\n"in\nput","out\n\nput"\n' + "".join(f"{value()},{value()}\n" for _ in range(100)), newline="")
    (folder / "b.csv").write_text("input,output\n" + "w\n" * 50 + '"never\nclosed\n', newline="")
    stored, materialise = [], pairs.materialise
    monkeypatch.setattr(pairs, "materialise", lambda df, label: stored.append(materialise(df, label)) or stored[-1])
    want = rows(pairs.csv_records(spark, str(folder)).select("record"))
    assert len(want) == 152 and ('  ',) in want and ('"never\nclosed',) in want
    assert stored[0].count() <= 4
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
        assert rows(pairs.csv_records(spark, str(folder), piece_bytes=1).select("record")) == want
        assert stored[-2].count() > 200
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)


def test_csv_without_rows(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("input,output\n")
    assert rows(pairs.load_pairs(spark, str(path))) == []
    path.write_text('\n"input",x\n"input",y\n')
    assert rows(pairs.load_pairs(spark, str(path))) == [("input", "")]


def test_training_needs_two_rows(spark):
    with pytest.raises(ValueError):
        pairs.training_subset(spark.range(1), "id")
    assert pairs.training_subset(spark.range(10), "id", 3).count() == 3


def test_dataset_is_written_once(spark, tmp_path):
    assert datasets.write_dataset(spark.range(5), str(tmp_path), "d") == 5
    assert datasets.write_dataset(spark.range(9), str(tmp_path), "d") is None
    assert datasets.read_dataset(spark, str(tmp_path), "d").count() == 5


def test_null_prompts_are_not_recorded(spark):
    df = spark.createDataFrame([("é", "r", 1), (None, "r", 2)], "prompt string, response string, s_input int")
    kinds = datasets.step_records(df, "s")
    assert rows(kinds["full"]) == [("", "r", 1)] and kinds["data_io"].columns == ["s_input"]


def test_save_all_keys_by_default(spark, tmp_path):
    path = str(tmp_path / "s")
    for _ in range(2):
        datasets.save_records(spark.createDataFrame([("ä", 1)], "a string, b int"), path)
    assert [json.loads(r.value) for r in spark.read.text(path).collect()] == [{"a": "", "b": 1}] * 2


def test_connectors(spark):
    tables.add_connector("range", lambda spark, n: spark.range(n))
    assert tables.connect(spark, "range", 4).count() == 4
    with pytest.raises(ValueError, match="unknown table source"):
        tables.connect(spark, "nope")
    tables.register({"four": spark.range(4)})
    assert tables.execute_query(spark, "SELECT count(*) FROM four; ").first()[0] == 4


@pytest.fixture
def feed(spark, tmp_path):
    """A folder of Parquet files that can be added to."""
    folder = str(tmp_path / "feed")

    def add(*texts, start=0):
        df = spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "doc_id int, text string")
        df.coalesce(1).write.mode("append").parquet(folder)

    add("a", "bad")
    add("c", start=2)
    return folder, add


def source(spark, folder):
    return jobs.read_files(spark, folder, "doc_id int, text string")


def test_stream_generate_retries_over_batches(spark, tmp_path, feed):
    """A request that fails is tried once by each of three batches, whatever the restarts; only then is it a dead letter."""
    folder, add = feed
    out, dead, check = (str(tmp_path / n) for n in ("ok", "dead", "check"))

    def run():
        prompts = source(spark, folder).withColumnRenamed("text", "prompt")
        jobs.stream_generate(prompts, refusing_model("bad"), out, dead, check, batch_size=1).awaitTermination()
        return state()

    def state():
        failed = spark.read.parquet(dead).select("doc_id", "attempts", F.size("error"))
        return rows(spark.read.parquet(out).select("doc_id", "response", "attempts")), rows(failed)

    assert run() == ([(0, "1:a", 1), (2, "1:c", 1)], [])
    assert run() == ([(0, "1:a", 1), (2, "1:c", 1)], [])  # nothing new came, so there was no batch
    add("dd", start=3)
    assert run() == ([(0, "1:a", 1), (2, "1:c", 1), (3, "2:dd", 1)], [])
    add("bad too", start=4)
    assert run()[1] == [(1, 3, 3)]
    for _ in range(2):
        jobs.finish_retries(spark, refusing_model("bad"), out, dead, batch_size=1)
        assert state() == ([(0, "1:a", 1), (2, "1:c", 1), (3, "2:dd", 1)], [(1, 3, 3), (4, 3, 3)])
    add("e", start=5)
    assert run()[0][-1] == (5, "1:e", 1) and len(state()[1]) == 2


def test_stream_generate_recovers_and_waits(spark, tmp_path, feed):
    folder, add = feed
    out, dead, check = (str(tmp_path / n) for n in ("ok", "dead", "check"))
    prompts = lambda: source(spark, folder).withColumnRenamed("text", "prompt")
    jobs.stream_generate(prompts(), refusing_model("bad"), out, dead, check, batch_size=1, wait_seconds=3600).awaitTermination()
    add("f", start=3)
    jobs.stream_generate(prompts(), refusing_model("none"), out, dead, check, batch_size=1, wait_seconds=3600).awaitTermination()
    assert rows(spark.read.parquet(out).select("doc_id")) == [(0,), (2,), (3,)]  # the failed one is not due yet
    jobs.finish_retries(spark, refusing_model("none"), out, dead, batch_size=1)
    assert rows(spark.read.parquet(out).filter("doc_id = 1").select("response", "attempts")) == [("3:bad", 2)]
    assert spark.read.schema("doc_id int").parquet(dead).isEmpty()


def test_a_replayed_batch_replaces_its_rows(spark, tmp_path, feed):
    folder, add = feed
    out, dead, check = (str(tmp_path / n) for n in ("ok", "dead", "check"))
    prompts = lambda: source(spark, folder).withColumnRenamed("text", "prompt")
    run = lambda: jobs.stream_generate(prompts(), refusing_model("bad"), out, dead, check, batch_size=1).awaitTermination()
    run()
    add("dd", start=3)
    run()
    # Forget that the second batch was finished: it runs again, from the ledger of the first.
    for name in ("1", ".1.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    run()
    assert rows(spark.read.parquet(out).select("doc_id")) == [(0,), (2,), (3,)]
    assert rows(jobs._waiting(spark, dead, 1).select("doc_id", "_attempts")) == [(1, 2)]


def test_stream_index_and_records(spark, tmp_path, feed):
    folder, add = feed
    for _ in range(2):
        jobs.stream_index(source(spark, folder), letter_encoder, str(tmp_path / "i"), str(tmp_path / "ci")).awaitTermination()
        jobs.stream_records(source(spark, folder), str(tmp_path / "r"), str(tmp_path / "cr"), ["text"]).awaitTermination()
    assert rows(retrieval.load_index(spark, str(tmp_path / "i")).select("split")) == [("a",), ("bad",), ("c",)]
    assert rows(spark.read.json(str(tmp_path / "r"))) == [("a",), ("bad",), ("c",)]


def test_stream_progress_ends(spark, tmp_path):
    """State lasts as long as a request is alive; late items are dropped, and a request that goes on later is added up."""
    folder, out, check = (str(tmp_path / n) for n in ("items", "out", "check"))
    schema = "request_id string, finish_reason string, at timestamp"

    def run(*items):
        """Items are (request, finish, minute)."""
        values = [(r, f, datetime(2024, 1, 1) + timedelta(minutes=m)) for r, f, m in items]
        spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(folder)
        query = jobs.stream_progress(jobs.read_files(spark, folder, schema), out, check)
        query.awaitTermination()
        kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        return kept, rows(jobs.latest_progress(spark, out))

    assert run(("a", "stop", 0), ("a", None, 1), ("b", "stop", 0), (None, "stop", 1), ("x", "stop", 0)) == (
        3, [("a", 2, 1, False, False), ("b", 1, 1, True, False), ("x", 1, 1, True, False)])
    # Time moves on: the first three are closed and forgotten.
    kept, got = run(("c", None, 30))
    assert kept == 1 and got == [("a", 2, 1, False, True), ("b", 1, 1, True, True), ("c", 1, 0, False, False), ("x", 1, 1, True, True)]
    # A late item of a closed request changes nothing; one in time opens an episode that counts on.
    kept, got = run(("b", None, 5), ("a", "stop", 31))
    assert kept == 2 and got == [("a", 3, 2, False, False), ("b", 1, 1, True, True), ("c", 1, 0, False, False), ("x", 1, 1, True, True)]
    kept, got = run(("d", "stop", 90))
    assert kept == 1 and [r[4] for r in got] == [True, True, True, False, True]
