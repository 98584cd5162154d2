"""Reshaping, comparison, catalog checks, evaluation and classifiers on hand-written rows."""

import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from promptloom.operators import catalog, classify, compare, evaluate, reshape
from promptloom.plans import experiments
from promptloom.testing.doubles import json_model, letter_encoder
from tests.conftest import plan, rows


def test_split_response_kinds(spark):
    maps = spark.createDataFrame([(1, "p", {"a": 1}), (2, "p", None)], "id int, prompt string, response map<string, int>")
    assert rows(reshape.split_response(maps)) == [(1, "", "a", "1")]
    texts = spark.createDataFrame([(1, "p", "text")], "id int, prompt string, response string")
    assert rows(reshape.split_response(texts)) == []


def test_concepts(spark):
    df = spark.createDataFrame([("[a, b ,]",), ("",), (None,)], "concepts_list string")
    assert rows(reshape.explode_concepts(df).select("concept")) == [("a",), ("b",)]


def test_zip_stops_at_the_shorter(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"]), (2, [], ["y"]), (3, None, ["z"])], "id int, q array<string>, t array<string>")
    assert rows(reshape.zip_shortest(df, "q", "t", ["id"])) == [(1, 0, "a", "x")]


def test_glossary_forms(spark):
    df = spark.createDataFrame([
        (1, '[{"input": "a\\nb", "output": "x"}, {"input": " c "}]', '[{"input": "e", "output": "f"}]'),
        (2, "not json", '{"input": "g", "output": "h"}\n{bad\n'),
        (3, '```\n{"glossary": [{"input": "a", "output": "b"}]}\n```', None),
        (4, None, ""),
    ], "id int, response string, input_glossary string")
    assert rows(reshape.merge_glossary(df, ["id"])) == [
        (1, "existing", 0, "e", "f"), (1, "generated", 0, "a", "x"), (1, "generated", 1, "c", ""), (2, "existing", 0, "g", "h"),
        (3, "generated", 0, "a", "b"),
    ]


def test_final_validation_counts_only_without_validation(spark):
    kind = ("array<struct<question: string, sub_question: string, generated_sql: string, original_sql: string, "
            "validation: struct<is_valid: boolean, error: string, explanation: string>, "
            "final_validation: struct<is_valid: boolean, error: string, explanation: string>>>")
    bad, good = (False, "e", "x"), (True, None, None)
    df = spark.createDataFrame([(
        [("q", None, "s", None, good, bad), ("r", None, None, "o", None, bad), ("n", None, None, None, None, None)], None,
    )], f"a {kind}, b {kind}")
    assert rows(reshape.failed_variations(df, ["a", "b"])) == [("a", "r", "o", "e", "x")]


def test_result_diff_counts_copies(spark):
    a = spark.createDataFrame([(1, 0.1 + 0.2), (1, 0.3), (2, -0.0), (None, None)], "k int, v double")
    b = spark.createDataFrame([(1, 0.3), (2, 0.0), (2, 0.0), (None, None)], "k int, v double")
    assert rows(compare.result_diff(a, b)) == [(1, 0.3, 2, 1), (2, 0.0, 1, 2)]
    assert compare.results_equal(a, a) and not compare.results_equal(a, b)
    assert not compare.results_equal(a, a.withColumnRenamed("v", "w"))
    assert compare.results_equal(a.select("k"), a.select(F.col("k").cast("long")))
    with pytest.raises(ValueError):
        compare.result_diff(a, a.select("k"))


def test_ordered_comparison(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "x"), (1, "y")], "k int, v string")
    assert compare.results_equal(a.select("v"), b.select("v"))
    assert not compare.result_diff(a, b, order_by=["k"]).isEmpty()


def test_score_against(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (3,)], "k int")
    assert compare.score_against(a, a).first() == (True, 0, 0)
    assert compare.score_against(a, b).first() == (False, 2, 1)
    assert compare.score_against(a, b.withColumnRenamed("k", "j")).first() == (False, None, None)


def test_pair_stats_of_nothing(spark):
    empty = compare.evaluate_sql_pairs(spark, [])
    assert compare.sql_pair_stats(empty).first() == (0, 0, 0, 0, 0.0, 0.0)
    assert "Equivalent: 0 (0.0%)" in compare.sql_pair_report(empty).first().line


def test_runtime_errors_are_case_errors(spark):
    spark.range(3).createOrReplaceTempView("three")
    out = compare.evaluate_sql_pairs(spark, [compare.SqlCase("q", "SELECT id FROM three", "SELECT raise_error('x') AS id FROM three")])
    assert out.first().status == "success" or out.first().confidence == 0.0
    bad = compare.SqlCase("q", "SELECT id FROM three;", "SELECT id + assert_true(id < 0) AS id FROM three")
    assert compare.evaluate_sql_pairs(spark, [bad]).first().equivalent is False


def test_profile_and_unknown_columns(spark):
    df = spark.createDataFrame([(2, None, [1]), (1, "b", [2])], "a int, b string, l array<int>")
    assert rows(catalog.schema_profile({"t": df}).select("column_name", "data_type", "sample_value")) == [
        ("a", "int", "1"), ("b", "string", "b"), ("l", "array<int>", None)]
    sql = spark.createDataFrame([
        (1, "select * from t where x = 'New York' and b = 'new york city'"), (2, "select a from t where b='q'"),
        (3, "select a from t where x='ab' and b='abc'"), (4, "select a from other where b = 'abc'"), (5, "nothing"),
    ], "id int, sql string")
    assert rows(catalog.unknown_columns(sql, {"t": ["a", "b"]}, "id", "sql")) == [
        (1, "T", "X", "New York", "B"), (3, "T", "X", "ab", None), (4, "OTHER", "B", "abc", None)]


def test_months(spark):
    df = spark.createDataFrame([("2024-02",), ("202413",), ("202402",), ("x",), (None,)], "m string")
    assert [str(r[0]) for r in df.select(catalog.month_to_date(F.col("m"))).collect()] == ["2024-02-01", "None", "2024-02-01", "None", "None"]
    assert catalog.month_profile(df).first() == ("m", 4, 3, 0.75)


def test_topics_skip_blank_questions(spark):
    df = spark.createDataFrame([(None, "q", ["a", "a"]), (" ", None, ["b"]), (None, None, ["c"])], "input string, question string, topics array<string>")
    assert rows(evaluate.topic_counts(df)) == [("a", 2)]


def test_coverage_is_strict(spark):
    sides = [({"a": 3, "b": 4, "c": 1, "C": 1}, True), ({"a": 2, "b": 2, "d": 5}, False)]
    asked = spark.createDataFrame(
        [("q", [t] * n, gold) for counts, gold in sides for t, n in counts.items()] + [("", ["z"], True)],
        "text string, topics array<string>, gold boolean",
    )
    coverage = evaluate.topic_coverage(asked, F.col("gold"))
    assert rows(evaluate.missing_topics(coverage)) == [("C", 1), ("c", 1)]
    assert rows(evaluate.underrepresented_topics(coverage)) == [("b", 2)]
    batch, = evaluate.topic_batches(coverage, rows_per_task=2).collect()
    assert tuple(batch)[:3] == (0, "C,c,b", 6)
    counts = {r.topic: r for r in coverage.collect()}
    assert batch.gold == ", ".join(f"{k}: {counts[k].gold_count}" for k in "Ccb")
    assert batch.generated == ", ".join(f"{k}: {counts[k].generated_count}" for k in "Ccb")


def test_classes_by_first_appearance_and_threshold(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("b", 1), ("c", 0)], "class_name string, position int")
    assert rows(classify.class_registry(df)) == [(0, "c"), (1, "b"), (2, "a")]
    probs = spark.createDataFrame([(1, 0, 0.4), (1, 1, 0.4), (1, 2, 0.2), (2, 0, 0.2)], "id int, class_id int, prob double")
    assert rows(classify.top_classes(probs, "id", 3, 0.2)) == [(1, 0, 0.4, 1), (1, 1, 0.4, 2)]
    assert [r[0] for r in probs.select(classify.binary_prediction(F.lit(0.5), F.col("prob"))).collect()] == [0, 0, 0, 0]


def test_full_classes_get_no_examples(spark):
    have = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "class_name string, example string")

    def fill(need):
        return need.select("class_name", F.explode(F.array(F.lit("x"), F.lit("y"))).alias("example"), F.lit(0).alias("sort_key"))

    assert rows(classify.augment_examples(have, 2, [fill, fill])) == [("a", "1", False), ("a", "2", False), ("b", "3", False), ("b", "x", True)]
    empty = classify.examples_needed(have, 3, classes=spark.createDataFrame([("c",), ("a",)], "class_name string"))
    assert rows(empty) == [("a", 2, 1), ("c", 0, 3)]


def test_classifier_with_nulls_and_an_empty_class(spark):
    registry = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "class_id int, class_name string")
    data = [("a", [1.0, 0.0]), ("c", [0.0, 1.0]), ("a", None), ("c", [0.1, 0.9])]
    vectors = spark.createDataFrame(data, "class_name string, embedding array<float>")
    with pytest.warns(UserWarning, match="'b'"):
        fitted = classify.EmbeddingClassifier.fit(vectors, registry)
    got = [(r.embedding is None, r.probs) for r in fitted.probabilities(vectors).collect()]
    assert all(len(p) == 3 and p[1] < 0.1 for gone, p in got if not gone) and [p for gone, p in got if gone] == [None]
    assert {r.class_name for r in fitted.predict(vectors.filter("embedding is null")).select(F.col("class_id"), F.lit(None).alias("class_name")).collect()} == {None}


def test_unseeded_classes_are_filled(spark):
    seen = spark.createDataFrame([("a", "1")], "class_name string, example string")
    names = spark.createDataFrame([("a",), ("b",)], "class_name string")
    make = lambda turn, current: lambda need: need.select(
        "class_name", F.concat("class_name", F.lit(str(turn))).alias("example"), F.lit(turn).alias("sort_key"))
    out = classify.augment_examples(seen, 3, make, classes=names)
    assert rows(out.groupBy("class_name").count()) == [("a", 3), ("b", 3)]
    with pytest.raises(ValueError, match="no example"):
        classify.augment_examples(seen, 3, lambda turn, current: lambda need: make(0, None)(need).limit(0), classes=names).count()


def test_commands_in_place_of_queries_do_not_run(spark):
    spark.range(3).createOrReplaceTempView("kept_view")
    cases = [compare.SqlCase("q", "SELECT id FROM kept_view", made) for made in (
        "DROP VIEW kept_view", "CREATE TEMPORARY VIEW other AS SELECT 1", "INSERT INTO kept_view VALUES (9)", "SELECT id FROM kept_view -- same")]
    got = compare.evaluate_sql_pairs(spark, cases)
    assert [r.status for r in got.orderBy("case_no").collect()] == ["error", "error", "error", "success"]
    assert spark.catalog.tableExists("kept_view") and not spark.catalog.tableExists("other")


def test_judge_sees_every_differing_row(spark):
    spark.range(120).createOrReplaceTempView("numbers")
    same = "SELECT id, 'x' AS v FROM numbers"
    cases = [
        compare.SqlCase("late", same, "SELECT id, CASE WHEN id < 119 THEN 'y' ELSE 'decides' END AS v FROM numbers"),
        compare.SqlCase("alias", "SELECT count(*) AS n FROM numbers", "SELECT count(*) AS cnt FROM numbers"),
        compare.SqlCase("shape", same, "SELECT id FROM numbers"),
    ]
    asked = []

    def judge(df):
        asked.extend(df.collect())
        differs = F.contains("generated_result", F.lit("decides"))
        return df.withColumns({"equivalent": ~differs, "confidence": F.when(differs, 0.7).otherwise(0.9), "explanation": F.concat(F.lit("chunk "), "chunk_no"),
                               "differences": F.when(differs, F.array(F.lit("the last row")))})

    got = {r.question: r for r in compare.evaluate_sql_pairs(spark, cases, judge=judge).collect()}
    late = [a for a in asked if a.case_no == 1]
    assert len(late) == 3 and sum(a.gold_result.count("{") for a in late) == sum(a.generated_result.count("{") for a in late) == 120
    assert (got["late"].equivalent, got["late"].confidence, got["late"].differences, got["late"].n_different) == (False, 0.7, ["the last row"], 240)
    assert got["late"].explanation.startswith("chunk ") and got["alias"].equivalent and got["alias"].explanation == "chunk 0"
    assert any(a.case_no == 2 and "columns: cnt" in a.generated_result for a in asked) and got["shape"].status == "success"


def test_columns_of_joined_tables_are_known(spark):
    df = spark.createDataFrame([(1, "select 1 from a join b on x = y where p = 'v' and q = 'w' and r = 'z'")], "id int, sql string")
    assert rows(catalog.unknown_columns(df, {"a": ["p"], "b": ["q"]}, "id", "sql").select("table_name", "column_name")) == [("A", "R")]


@pytest.mark.parametrize("sql, found", [
    ("SELECT n_name FROM nation, region WHERE n_regionkey = r_regionkey AND r_name = 'ASIA'", []),
    ("SELECT 1 FROM nation n, region AS r WHERE n.r_name = 'ASIA' AND r.r_name = 'ASIA'", [("NATION", "R_NAME", "ASIA", "R_NAME")]),
    ("WITH x AS (SELECT n_name AS name FROM nation) SELECT * FROM x WHERE name = 'PERU'", []),
    ("WITH x AS (SELECT n_name AS name FROM nation n WHERE n.nope = 'a') SELECT * FROM x WHERE name = 'PERU'", [("NATION", "NOPE", "a", None)]),
    ("SELECT 1 FROM (SELECT n_name AS a FROM nation) t WHERE a = 'x' AND t.b = 'y'", []),
    ("SELECT 1 FROM nation WHERE n_name = 'copied from orders where x = ''y'''", []),
    ("SELECT 1 FROM nation -- from region\nWHERE r_name = 'ASIA'", [("NATION", "R_NAME", "ASIA", None)]),
    ("SELECT 1 FROM main.\"nation\" x JOIN region USING (k) WHERE x.\"R_NAME\" = 'it''s' AND x.n_name <= 'a'", [("NATION", "R_NAME", "it's", None)]),
    ("SELECT 1 FROM nation WHERE n_name IN (SELECT r_name FROM region WHERE r_name = 'ASIA') AND n_comment = 'ASI'", [("NATION", "N_COMMENT", "ASI", "R_NAME")]),
    ("SELECT 1 FROM nation, (SELECT 1 AS b) WHERE b = 'x'", []),
    ("SELECT 1 FROM range(3) WHERE id = 'x'", []),
])
def test_columns_in_scope(spark, sql, found):
    df = spark.createDataFrame([(1, sql)], "id int, sql string")
    tables = {"nation": ["n_name", "n_regionkey"], "region": ["r_name", "r_regionkey"]}
    assert [r[1:] for r in rows(catalog.unknown_columns(df, tables, "id", "sql"))] == found


def test_results_with_repeated_names(spark):
    spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "k int, g int").createOrReplaceTempView("twice")
    pairs = "SELECT a.k, b.k FROM twice a JOIN twice b ON a.g = b.g"
    swapped = "SELECT b.k, a.k FROM twice a JOIN twice b ON a.g = b.g AND a.k < 3"
    out = compare.evaluate_sql_pairs(spark, [compare.SqlCase("same", pairs, pairs), compare.SqlCase("less", pairs, swapped)]).orderBy("case_no").collect()
    assert [(r.status, r.equivalent, r.n_different) for r in out] == [("success", True, 0), ("success", False, 1)]
    diff = compare.result_diff(spark.sql(pairs), spark.sql(swapped))
    assert diff.columns == ["k", "k_2", "n_left", "n_right"] and rows(diff) == [(3, 3, 1, 0)]
    assert compare.score_against(spark.sql(swapped), spark.sql(pairs)).first() == (False, 0, 1)
    clash = spark.sql("SELECT 1 AS n_left, 2 AS N_LEFT")
    assert compare.result_diff(clash, clash.limit(0)).columns == ["n_left_2", "N_LEFT_3", "n_left", "n_right"]


def test_fingerprints(spark):
    a = spark.createDataFrame([(1, 0.0, {"k": 1}), (2, None, None), (2, None, None)], "i int, x double, m map<string,int>")
    same = spark.createDataFrame([(2, None, None), (1, -0.0000001, {"k": 1}), (2, None, None)], "j long, y float, m map<string,int>")
    prints = [compare.fingerprint(d, 6).first() for d in (a, same, a.limit(2), a.limit(0))]
    assert prints[0] == prints[1] and len({*prints}) == 3 and prints[3] == (0, "0", "0")


def test_one_failing_case_spoils_no_other(spark):
    spark.range(3).createOrReplaceTempView("three")
    good = compare.SqlCase("good", "SELECT id FROM three", "SELECT id FROM three ORDER BY id DESC")
    bad = compare.SqlCase("bad", "SELECT id FROM three", "SELECT id DIV (id - 1) AS id FROM three")
    out = compare.evaluate_sql_pairs(spark, [good, bad, good]).orderBy("case_no").collect()
    assert [(r.status, r.confidence) for r in out] == [("success", 1.0), ("error", 0.0), ("success", 1.0)]


def test_classifier_trains_saves_and_loads(spark, tmp_path):
    names = spark.createDataFrame([("vowels", "a e i"), ("rest", "x y z")], "class_name string, description string")
    examples = spark.createDataFrame([("vowels", "aeiou"), ("rest", "xyz")], "class_name string, example string")
    model = json_model(**{f"example_{i}": (lambda p: "aei" if "a e i" in p or "aei" in p else "xyy") for i in range(1, 6)},
                       output=lambda p: "aaee" if "a e i" in p else "xxyz")
    fitted = experiments.train_from_descriptions(names, examples, model, letter_encoder, target=6)
    texts = spark.createDataFrame([(1, "aaeeii"), (2, "zzyx")], "id int, text string")
    from promptloom.operators.inference import embed

    vectors = embed(texts, letter_encoder)
    assert rows(fitted.predict(vectors).select("id", "class_name")) == [(1, "vowels"), (2, "rest")]
    fitted.save(str(tmp_path / "m"))
    again = classify.EmbeddingClassifier.load(spark, str(tmp_path / "m"))
    assert rows(again.predict(vectors).select("id", "class_name")) == [(1, "vowels"), (2, "rest")]
    long = again.long_probabilities(vectors, ["id"])
    assert long.count() == 4 and all(abs(r[0] - 1) < 1e-9 for r in long.groupBy("id").agg(F.sum("prob").alias("s")).select("s").collect())
    metadata = spark.createDataFrame([(0, "zero"), (1, "one")], "class_id int, note string")
    ranked = again.classify(vectors, "id", top_n=1, threshold=0.5, metadata=metadata)
    assert rows(ranked.select("id", "class_name", "rank")) == [(1, "vowels", 1), (2, "rest", 1)]
    assert "note" in ranked.columns and again.classify(vectors, "id").count() == 4
    assert rows(again.binary(vectors, negative="rest", positive="vowels").select("id", "prediction")) == [(1, 1), (2, 0)]
    with pytest.raises(ValueError, match="lacks"):
        again.binary(vectors)
    one_class = names.limit(1).select("class_name").withColumn("class_id", F.lit(0))
    with pytest.raises(ValueError, match="two classes"):
        classify.EmbeddingClassifier.fit(embed(examples, letter_encoder, "example"), one_class)


def test_logistic_regression_minimises_the_textbook_objective(spark):
    """At the fitted weights the gradient of 0.5·|w|² + Σ log-loss vanishes."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3)).astype("float32")
    y = rng.integers(0, 3, 60)
    df = spark.createDataFrame([([float(v) for v in r], f"c{c}") for r, c in zip(x, y)], "embedding array<float>, class_name string")
    registry = spark.createDataFrame([(i, f"c{i}") for i in range(3)], "class_id int, class_name string")
    model = classify.EmbeddingClassifier.fit(df, registry).model
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    logits = x.astype("float64") @ w.T + b
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    gradient = (p - np.eye(3)[y]).T @ x.astype("float64") + w
    assert np.abs(gradient).max() < 1e-4


def test_a_round_makes_all_missing_examples(spark):
    import re

    names = spark.createDataFrame([("a", "first"), ("b", "second")], "class_name string, description string")
    seen = spark.createDataFrame([("a", "1")], "class_name string, example string")
    said = lambda i: lambda p: "d" + str(i) if p.startswith("Existing") else f"s{i}" + "".join(re.findall(r"Request (\d+)", p))
    model = json_model(**{f"example_{i}": said(i) for i in range(1, 6)}, output=lambda p: p.split("example:\n")[-1].split("\n")[0])
    out = classify.augment_examples(seen, 26, [experiments.example_round(names, seen, model)], classes=names)
    assert rows(out.groupBy("class_name").count()) == [("a", 26), ("b", 26)]
    assert {"s1", "s12", "s5", "s52"} <= {r.example for r in out.filter("class_name = 'a'").collect()}


def test_registered_augmentation_fills_every_class(spark):
    from promptloom.registry import QUERIES
    from tests.conftest import TESTDATA

    sizes = rows(QUERIES["augment_with_model"](spark, TESTDATA).groupBy("class_name").count())
    assert len(sizes) > 1 and len({n for _, n in sizes}) == 1


def test_profile_from_footers(spark, tmp_path):
    def stored(name, df):
        df.write.parquet(str(tmp_path / name))
        return str(tmp_path / name)

    rows_ = [(i, f"s{i % 5}", i % 2 == 0, i / 7 - 1, None, date(2020, 1, 1 + i), [i], Decimal(i)) for i in range(20)]
    schema = "`a b` long, s string, t boolean, d double, n int, day date, l array<int>, m decimal(5, 1)"
    full = spark.createDataFrame(rows_, schema).repartition(3)
    paths = {
        "full": stored("full", full.drop("n")), "nulls": stored("nulls", full), "empty": stored("empty", full.drop("n").limit(0)),
        "whole": stored("whole", full.select("a b", "day")), "parts": f"{tmp_path}/parts",
    }
    full.select("a b", "s", F.lit(4).alias("p")).write.partitionBy("p").parquet(paths["parts"])
    got = catalog.footer_profile(spark, paths)
    assert rows(got) == rows(catalog.schema_profile({n: spark.read.parquet(p) for n, p in paths.items()}))
    assert {r.column_name: r.sample_value for r in got.filter("table_name = 'whole'").collect()} == {"a b": "0", "day": "2020-01-01"}
    # Footers alone: no data column is read, and the caller's settings are as before.
    assert re.search(r"PushedAggregation: \[MIN\(`?a b`?\)", catalog.footer_minima(spark, paths["whole"], ["a b"])._jdf.queryExecution().executedPlan().toString())
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    scanned = plan(catalog.footer_profile(spark, {"full": paths["full"]}))
    assert "day" not in re.search(r"ReadSchema: (\S+)", scanned)[1]
    assert "FileScan" not in plan(catalog.footer_profile(spark, {"whole": paths["whole"]}))
