"""Model calls, caching, dead letters, chains and retrieval plumbing, with test doubles."""

import json
import random
import re

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from promptloom.operators import inference, retrieval
from promptloom.plans import specs
from promptloom.plans.specs import SPECS
from promptloom.plans.steps import AgenticRun
from promptloom.storage import CHECKPOINT_CONF, materialise, scratch_path
from promptloom.testing.doubles import echo_model, json_model, letter_encoder, refusing_model
from tests.conftest import plan, rows


def prompts(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, prompt string").coalesce(1)


def test_retries_until_the_limit(spark):
    out = inference.generate(prompts(spark, "a", "bad"), refusing_model("bad"), batch_size=1, retry_limit=3)
    assert [(r.id, r.response, r.attempts, len(r.error)) for r in out.orderBy("id").collect()] == [(0, "1:a", 1, 0), (1, None, 3, 3)]
    assert out.filter("id = 1").first().error[0] == "RuntimeError: refused"


def test_a_flaky_model_succeeds_later(spark):
    def flaky():
        calls = []

        def predict(p):
            calls.append(1)
            if len(calls) == 1:
                raise OSError("busy")
            return p
        return predict

    first = inference.generate(prompts(spark, "a"), flaky).first()
    assert (first.response, first.attempts, first.error) == ("a", 2, ["OSError: busy"])


def test_a_failing_batch_takes_all_its_rows(spark):
    out = inference.generate(prompts(spark, "a", "bad", "c"), refusing_model("bad"), batch_size=2)
    assert [r.response for r in out.orderBy("id").collect()] == [None, None, "1:c"]


def test_batches_have_the_given_size(spark):
    def sizes():
        return lambda p: pd.Series([str(len(p))] * len(p))

    out = inference.generate(prompts(spark, *"abcdefg"), sizes, batch_size=3)
    assert [r.response for r in out.orderBy("id").collect()] == ["3"] * 6 + ["1"]


def test_wrong_number_of_answers_fails_the_batch(spark):
    out = inference.generate(prompts(spark, "a", "b"), lambda: lambda p: ["x"], retry_limit=1)
    assert all("returned 1 responses for 2" in r.error[0] for r in out.collect())


def test_no_answer_is_not_a_dead_letter(spark):
    answered, failed = inference.split_failed(inference.generate(prompts(spark, "", "x"), echo_model))
    assert answered.count() == 2 and failed.count() == 0


def test_only_the_prompt_reaches_python(spark):
    df = spark.createDataFrame([(1, "p", "wide")], "id int, prompt string, payload string")
    text = plan(inference.generate(df, echo_model).select("id", "payload", "response", "attempts"))
    assert text.count("ArrowEvalPython") == 1
    assert re.search(r"ArrowEvalPython \[call\(prompt#\d+\)", text)  # the only argument


def test_parse_failures_are_flagged(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{",), ("[]",), (None,), ('{"b": "x", "a": null}',)], "response string")
    out = inference.parse_response(df, {"a": "int", "b": "str"})
    assert [(r.parse_ok, r.response and r.response.a) for r in out.collect()] == [(True, 1), (False, None), (False, None), (False, None), (True, None)]


def test_cache_asks_once_per_prompt_and_skips_failures(spark, tmp_path):
    cache, log = str(tmp_path / "cache"), tmp_path / "calls"
    log.mkdir()

    def counting():
        predict = refusing_model("bad")()

        def call(p):
            for text in p:
                with open(log / "calls.txt", "a") as f:
                    f.write(text + "\n")
            return predict(p)
        return call

    df = prompts(spark, "a", "a", "bad", "b", "a")
    first = inference.cached_generate(df, counting, "m", cache, batch_size=1, retry_limit=1)
    assert [(r.response, r.cache_hit) for r in first.orderBy("id").collect()] == [
        ("1:a", False), ("1:a", False), (None, False), ("1:b", False), ("1:a", False)]
    assert sorted((log / "calls.txt").read_text().split()) == ["a", "b", "bad"]
    second = inference.cached_generate(df, counting, "m", cache, batch_size=1, retry_limit=1)
    assert [r.cache_hit for r in second.orderBy("id").collect()] == [True, True, False, True, True]
    assert sorted((log / "calls.txt").read_text().split()) == ["a", "b", "bad", "bad"]
    assert inference.cached_generate(prompts(spark, "a"), echo_model, "other", cache).first().cache_hit is False
    assert spark.read.parquet(cache).count() == 3


def test_a_dominant_prompt_is_split_when_answers_are_joined_back(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 6000, 1, 8).select("id", F.when(F.col("id") % 3 != 0, "hot").otherwise(F.col("id").cast("string")).alias("prompt"))
        out = inference.cached_generate(df, echo_model, "m", str(tmp_path / "cache"), batch_size=64)
        assert out.count() == 6000
        rows_of = out.select("id", "response")
        rows_of.collect()
        assert "skew=true" in rows_of._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_null_prompts_stay_out_of_the_cache(spark, tmp_path):
    cache = str(tmp_path / "cache")
    out = inference.cached_generate(prompts(spark, "a", None), echo_model, "m", cache)
    assert [r.response for r in out.orderBy("id").collect()] == ["1:a", None]
    assert spark.read.parquet(cache).count() == 1


def test_request_key_depends_on_every_part(spark):
    keys = spark.range(1).select(
        inference.request_key("m", F.lit("p")), inference.request_key("n", F.lit("p")), inference.request_key("m", F.lit("q")),
        inference.request_key("m", F.lit("p"), {"a": "str"}),
    ).first()
    assert len(set(keys)) == 4


def test_embedding_skips_nulls(spark):
    df = spark.createDataFrame([(1, "abba"), (2, None), (3, "")], "id int, text string").coalesce(1)
    got = {r.id: r.embedding for r in inference.embed(df, letter_encoder).collect()}
    assert got[2] is None and sum(got[3]) == 0 and got[1][:3] == pytest.approx([0.7071068, 0.7071068, 0.0])


def test_request_progress(spark):
    items = spark.createDataFrame([(1, "stop"), (1, None), (2, "stop")], "request_id int, finish_reason string")
    assert rows(inference.request_progress(items)) == [(1, 2, 1, False), (2, 1, 1, True)]


def test_agentic_run_checks_records_and_filters(spark, tmp_path):
    model = json_model(concept=lambda p: p[-1], sql=lambda p: "select 1", thinking_steps=lambda p: "t", is_factual=lambda p: p.endswith("a"))
    run = AgenticRun(
        {n: SPECS[n] for n in ("question_to_concept", "concept_to_sql")}, {"factuality": SPECS["factuality"]}, model,
        order=["question_to_concept", "nope", "concept_to_sql", "factuality"], record_dir=str(tmp_path / "rec"), record_steps=True,
        record_results=True, save_path=str(tmp_path / "saved"), save_keys=["concept", "sql"], keep_only_valid=True,
    )
    df = spark.createDataFrame([("what a", "a"), ("what b", "b")], "question string, answer string")
    with pytest.raises(ValueError, match="factuality"):
        run.run(df.drop("answer"))
    out = run.run(df, spot_check=True)
    assert rows(out.select("concept", "sql", "orig_prompt")) == [("a", "select 1", "Name the business concept behind this question.\nwhat a")]
    assert spark.read.json(str(tmp_path / "saved")).first().asDict() == {"concept": "a", "sql": "select 1"}
    kinds = sorted(p.name for p in (tmp_path / "rec").iterdir())
    assert kinds == ["concept_to_sql_data_io", "concept_to_sql_full", "concept_to_sql_prompt_response", "data_io", "factuality_data_io",
                     "factuality_full", "factuality_prompt_response", "question_to_concept_data_io", "question_to_concept_full",
                     "question_to_concept_prompt_response"]
    assert spark.read.json(str(tmp_path / "rec" / "question_to_concept_data_io")).columns == ["question_to_concept_input", "question_to_concept_output"]


def test_start_from_skips_steps(spark):
    model = json_model(sql=lambda p: p.rsplit("\n", 1)[1])
    run = AgenticRun({n: SPECS[n] for n in ("question_to_concept", "concept_to_sql")}, {}, model)
    assert run.run(spark.createDataFrame([("c",)], "concept string"), start_from=1).first().sql == "c"


def test_index_grows_without_repeats(spark, tmp_path):
    path, df = str(tmp_path / "index"), spark.createDataFrame([(1, "aa"), (2, "bb"), (3, None)], "doc_id int, text string")
    retrieval.save_index(retrieval.index_rows(df.filter("doc_id = 1"), "text", letter_encoder, ["doc_id"]), path)
    for _ in range(2):
        retrieval.append_to_index(df.union(df), path, "text", letter_encoder, ["doc_id"])
    assert rows(retrieval.load_index(spark, path).select("split")) == [("aa",), ("bb",)]

    def no_encoder():
        def encode(texts):
            raise AssertionError("a known text reached the encoder")
        return encode

    retrieval.append_to_index(df, path, "text", no_encoder, ["doc_id"])


def test_null_prompts_are_left_out(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "c")], "id int, prompt string").coalesce(1)
    strict = lambda: lambda prompts: [len(p) * "x" for p in prompts]
    got = rows(inference.generate(df, strict).select("id", "response", "error", "attempts"), "id")
    assert got == [(1, "xx", [], 1), (2, None, [], 0), (3, "x", [], 1)]


def test_cache_stores_each_new_prompt_once(spark, tmp_path, monkeypatch):
    """One table tells hits from misses; the prompts of hits are not written again."""
    cache, stored = str(tmp_path / "cache"), {}
    inference.cached_generate(prompts(spark, "a", "b"), echo_model, "m", cache)
    monkeypatch.setattr(inference, "materialise", lambda df, label: stored.setdefault(label, materialise(df, label)))
    out = inference.cached_generate(prompts(spark, "a", "b", "b", "new", "new", None), echo_model, "m", cache)
    assert rows(out.select("id", "response", "cache_hit")) == [
        (0, "1:a", True), (1, "1:b", True), (2, "1:b", True), (3, "3:new", False), (4, "3:new", False), (5, None, None)]
    assert sorted(stored) == ["fresh", "lookups"]
    assert rows(stored["lookups"].select("prompt", "response")) == [("new", None), (None, "1:a"), (None, "1:b")]


def test_cache_keeps_errors(spark, tmp_path):
    df = spark.createDataFrame([(1, "ok"), (2, "bad")], "id int, prompt string")
    out = inference.cached_generate(df, refusing_model("bad"), "m", str(tmp_path / "cache"), batch_size=1)
    got = {r.id: r for r in out.collect()}
    assert got[1].response and got[1].error == [] and got[2].response is None and len(got[2].error) == got[2].attempts == 3
    again = {r.id: r for r in inference.cached_generate(df, refusing_model("bad"), "m", str(tmp_path / "cache"), batch_size=1).collect()}
    assert again[1].cache_hit and again[1].attempts == 0 and not again[2].cache_hit


def test_spot_check_ignores_verdicts_and_verdicts_are_named(spark):
    spec = specs.validator_spec("check", "Look at {answer}", {"needs_review": "bool"}, "is_valid")
    assert spec.verdict_field == "is_valid"
    model = json_model(is_valid=lambda p: "good" in p, needs_review=lambda p: "bad" in p)
    run = AgenticRun({}, {"check": spec}, model, keep_only_valid=True)
    out = run.run(spark.createDataFrame([("bad",), ("good",)], "answer string").coalesce(1), spot_check=True)
    assert [r.answer for r in out.collect()] == ["good"]


def test_augmentation_by_slot_and_without_hits(spark):
    asked = spark.createDataFrame([(1, "use {context} now"), (2, "no {context}")], "query_id int, prompt string")
    hits = spark.createDataFrame([(1, 2, "second"), (1, 1, "first")], "query_id int, rank int, split string")
    assert rows(retrieval.augment_prompts(asked, hits, slot="context"), "query_id") == [(1, "use first\nsecond now"), (2, "no ")]
    assert rows(retrieval.augment_prompts(asked, hits), "query_id")[0] == (1, "use {context} nowfirst\nsecond")


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get(CHECKPOINT_CONF)
    path = scratch_path(spark, "x")
    assert path.startswith(root) and path != scratch_path(spark, "x")
    assert materialise(spark.range(3)).count() == 3


def test_doubles():
    assert list(echo_model()(pd.Series(["ab", "", None]))) == ["2:ab", None, None]
    assert json.loads(json_model(n=len)()(pd.Series(["abc"]))[0]) == {"n": 3}


def test_an_index_is_read_by_cell_and_by_prefix(spark, tmp_path):
    """A search opens the files of the cells it visits, an append those of the ids it may hold, and an unfinished append is never seen."""
    path, words = str(tmp_path / "index"), [a * n + b for a in "abcdefgh" for b in "xyz" for n in (1, 2, 3)]
    df = spark.createDataFrame(list(enumerate(words)), "doc_id int, text string")
    rows_of = retrieval.index_rows(df.filter("doc_id < 60"), "text", letter_encoder, ["doc_id"])
    retrieval.save_index(rows_of, path, cell_rows=6, id_digits=2)
    assert retrieval.append_to_index(df, path, "text", letter_encoder, ["doc_id"]) == len(words) - 60
    index = retrieval.open_index(spark, path)
    assert index.version == 1 and len(index.pivots) == 10 and index.count.sum() == len(words)
    one = inference.embed(spark.createDataFrame([(1, "aaax")], "query_id int, text string"), letter_encoder, "text")
    report = {}
    got = retrieval.nearest(one, index, 2, report=report)
    assert rows(got.select("rank", F.round("distance", 6))) == [(1, 0.0), (2, round(2 - 2 * 7 / 50**0.5, 6))]
    assert 0 < report["pairs"] < len(words)
    read = index.cells().read([0])
    assert re.search(r"PartitionFilters: \[[^\]]*_cell", plan(read))
    files = lambda df: df.select(F.input_file_name()).distinct().count()
    assert 0 < files(index.rows.filter("_cell = 0")) < files(index.rows)
    # Rows of an append whose manifest is missing stay unseen, and the next append writes over them.
    rows_of.write.parquet(f"{path}/rows/batch=2/_cell=0")
    assert retrieval.load_index(spark, path).count() == len(words)
    more = spark.createDataFrame([(1000, "new text")], "doc_id int, text string")
    assert retrieval.append_to_index(more, path, "text", letter_encoder, ["doc_id"]) == 1
    assert retrieval.load_index(spark, path).count() == len(words) + 1
    assert retrieval.append_to_index(more, path, "text", letter_encoder, ["doc_id"]) == 0 and retrieval.open_index(spark, path).version == 2


def test_retrieve_from_a_stored_index(spark, tmp_path):
    path = str(tmp_path / "index")
    df = spark.createDataFrame([(i, f"{c * 9}{i}") for i, c in enumerate("abcdefghij")], "doc_id int, text string")
    retrieval.append_to_index(df, path, "text", letter_encoder, ["doc_id"])
    prompts = spark.createDataFrame([(1, "dd"), (2, "jj")], "query_id int, prompt string")
    got = retrieval.rag_prompts(prompts, retrieval.open_index(spark, path), letter_encoder, 1)
    assert rows(got.select("query_id", "prompt")) == [(1, "ddddddddddd3"), (2, "jjjjjjjjjjj9")]
    assert retrieval.open_index(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        retrieval.load_index(spark, str(tmp_path / "none"))


def test_the_cache_is_read_by_prefix_and_compacted(spark, tmp_path):
    cache = str(tmp_path / "cache")
    words = [f"w{i}" for i in range(40)]
    inference.cached_generate(prompts(spark, *words), echo_model, "m", cache)
    inference.cached_generate(prompts(spark, *words, "new"), echo_model, "m", cache)
    for name in sorted(p.name for p in (tmp_path / "cache").iterdir() if p.name.startswith("prefix=")):
        assert len(name) == len("prefix=0")
    one = inference.read_cache(spark, cache, ["0"])
    assert "PartitionFilters: [isnotnull(prefix" in plan(one) and "(prefix" in plan(one)
    assert rows(inference.read_cache(spark, cache).select("response")) == sorted((f"{len(w)}:{w}",) for w in [*words, "new"])
    extra = spark.read.parquet(cache).limit(3)
    materialise(extra).write.mode("append").partitionBy("prefix").parquet(cache)
    inference.compact_cache(spark, cache)
    assert spark.read.parquet(cache).count() == 41
    assert all(len([f for f in p.iterdir() if f.suffix == ".parquet"]) == 1 for p in (tmp_path / "cache").iterdir() if p.is_dir())
    hits = inference.cached_generate(prompts(spark, *words, "new"), refusing_model("w"), "m", cache)
    assert hits.filter("cache_hit").count() == 41


def test_stored_steps_write_no_prompt(spark, monkeypatch):
    """What a step stores is its input columns and the answers; the rest is made again, without a model call."""
    from promptloom.plans import specs as module

    seen = []
    monkeypatch.setattr(module, "materialise", lambda df, label: seen.append(df.columns) or materialise(df, label))
    calls = spark.sparkContext.accumulator(0)

    def model():
        def predict(batch):
            calls.add(len(batch))
            return batch.map(lambda p: json.dumps({"concept": p[-1]}))
        return predict

    df = spark.createDataFrame([(1, "qa"), (2, "qb")], "id int, question string")
    out = SPECS["question_to_concept"].run(df, model)
    want = SPECS["question_to_concept"].apply(df, json_model(concept=lambda p: p[-1]))
    assert seen == [["id", "question", "response", "error", "attempts"]]
    assert out.columns == want.columns and rows(out) == rows(want) and rows(out.select("concept")) == [("a",), ("b",)]
    assert calls.value == 2
    asks_prompt = specs.PromptSpec("again", "Improve: {prompt}", {"concept": "str"})
    assert rows(asks_prompt.run(df.withColumn("prompt", F.lit("x")), json_model(concept=lambda p: p)).select("concept", "prompt", "again_input.prompt")) == [
        ("Improve: x", "Improve: x", "x")] * 2


def test_budget_batches():
    rng = random.Random(3)
    lengths = [min(5000, int(rng.paretovariate(0.8) * 20)) for _ in range(2000)] + [0, 0, 9999]
    rows_ = [i for i in range(len(lengths)) if i % 7]
    padding = lambda batches: sum(len(b) * max(lengths[i] for i in b) - sum(lengths[i] for i in b) for b in batches)
    got = inference.budget_batches(rows_, lengths, 4000, 32)
    assert sorted(i for b in got for i in b) == rows_
    assert all(len(b) <= 32 and (len(b) == 1 or len(b) * max(lengths[i] for i in b) <= 4000) for b in got)
    assert padding(got) * 10 < padding(inference.fixed_batches(rows_, 16))
    assert inference.budget_batches([], [], 10) == [] and inference.budget_batches([1], [3, 99], 10) == [[1]]


def test_encoder_and_model_keep_to_the_budget(spark):
    texts = ["x" * n for n in (3, 900, 1, 40, 41, 7, 2000, 0, 5)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)

    def encoder():
        return lambda batch: [[float(len(x)), float(len(batch) * batch.str.len().max())] for x in batch]

    got = {r.id: r.embedding for r in inference.embed(df, encoder, budget=100).collect()}
    assert [got[i] and got[i][0] for i in range(10)] == [None if x is None else float(len(x)) for x in texts]
    assert all(v is None or v[1] <= 100 or v[0] == v[1] for v in got.values())

    def failing():
        def answer(batch):
            if batch.str.len().max() > 1000:
                raise ValueError("too long")
            return batch + "!"
        return answer

    out = {r.id: r for r in inference.generate(df, failing, "text", batch_size=4, budget=2000).collect()}
    assert all(out[i].response == (None if i in (6, 9) else texts[i] + "!") for i in range(10))
    assert (out[6].attempts, len(out[6].error), out[9].attempts) == (3, 3, 0)

    def short():
        return lambda batch: [[1.0]]

    with pytest.raises(PySparkException, match="encoder returned 1 embeddings"):
        inference.embed(df, short).collect()


def test_an_answer_is_parsed_once(spark):
    """Filters on parsed fields stay above the parser."""
    df = spark.createDataFrame([(1, '{"a": "x", "b": 2.0}'), (2, "no")], "id int, response string")
    out = inference.parse_response(df, {"a": "str", "b": "float"}).filter("parse_ok")
    assert rows(out.select("id", "response.a", "response.b")) == [(1, "x", 2.0)]
    assert plan(out).split("Initial Plan")[0].count("from_json") == 1
