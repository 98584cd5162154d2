"""Templates, text clean-up and schemas on hand-written rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.functions import schema, sql, templates, text
from promptloom.operators import evaluate, records
from promptloom.plans.specs import SPECS, PromptSpec, validator_spec
from tests.conftest import plan, rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def test_render_names_missing_keys(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(templates.render("{a}-{b}-{a}", df.columns)).first()[0] == "1-None-1"
    assert df.select(templates.render("plain", df.columns)).first()[0] == "plain"
    assert df.select(templates.render("", df.columns)).first()[0] == ""
    with pytest.raises(ValueError, match=r"\['c'\]"):
        templates.render("{a}{c}", df.columns)


def test_render_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert "Python" not in plan(df.select(templates.render("{a} {b}", df.columns)))


def test_chat_default_only_when_system_is_empty(spark):
    df = spark.createDataFrame([("u", ""), ("u", None), ("u", "S")], "u string, s string")
    got = [r[0] for r in df.select(templates.chat_prompt("mistral", F.col("u"), F.col("s"), "D")).collect()]
    assert got == ["<s>[INST] D u [/INST]"] * 2 + ["<s>[INST] S u [/INST]"]


@pytest.mark.parametrize("name, found", [
    ("SELECT 1", "SELECT 1"),
    ("no sql here", None),
    ("Use it with care: SELECT a FROM t;\nEnjoy!", "SELECT a FROM t;"),
    ("Sure.\n```sql\nSELECT a\n```", "SELECT a"),
    ("WITH x AS (SELECT 1) SELECT * FROM x;;", "WITH x AS (SELECT 1) SELECT * FROM x;"),
    ("SELECT 1; then select 2", "SELECT 1; then select 2"),
    ("", None),
    ("SELECT 'a;b' AS x", "SELECT 'a;b' AS x"),
    ("SELECT 'a;b' AS x; That's all; really.", "SELECT 'a;b' AS x;"),
    ("I would select rows with a filter.", None),
    ("Here's the query: select a from t where b = 'it''s; here'", "select a from t where b = 'it''s; here'"),
    ("You could select a from t;", "select a from t;"),
    ("select 1 -- one; two\n", "select 1 -- one; two"),
    ("SELECT \"a;b\" FROM t /* ; */ WHERE x = 1; Done", "SELECT \"a;b\" FROM t /* ; */ WHERE x = 1;"),
    ("(SELECT 1) UNION (SELECT 2)", "(SELECT 1) UNION (SELECT 2)"),
    ("Answer:\n  select `a;b` from t; select c from d; ok?", "select `a;b` from t; select c from d;"),
    ("SELECT '" + "x;" * 30_000 + "' AS long; bye", "SELECT '" + "x;" * 30_000 + "' AS long;"),
])
def test_extract_sql(spark, name, found):
    assert one(spark, text.extract_sql(F.lit(name))) == found


@pytest.mark.parametrize("raw, body", [
    ("```json\n[1]\n```", "[1]"), ("  x  ", "x"), ("```\na\n```b", "a"), ("```", ""), ("a\n```", "a\n```"), ("```\na\nb", "a\nb"),
])
def test_strip_fence(spark, raw, body):
    assert one(spark, text.strip_fence(F.lit(raw))) == body


def test_terminate_sql(spark):
    assert one(spark, text.terminate_sql(F.lit(" a \n"))) == "a;"
    assert one(spark, text.terminate_sql(F.lit(" a;\n"))) == "a;"
    assert one(spark, text.terminate_sql(F.lit("a -- b;"))) == "a -- b;\n;"
    assert one(spark, text.terminate_sql(F.lit("a; -- b"))) == "a; -- b"
    assert one(spark, text.terminate_sql(F.lit("a = ';"))) == "a = ';;"


@given(st.text(alphabet="ab;'\"`-/*\n \\_9.()", max_size=40))
@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_sql_tokens_make_up_the_text(spark, value):
    df = spark.createDataFrame([(value,)], "v string")
    assert tuple(df.select(F.array_join(sql.tokens(F.col("v")), ""), F.length(sql.masked(F.col("v")))).first()) == (value, len(value))


@pytest.mark.parametrize("value, size, overlap, chunks", [
    ("abcdefg", 3, 0, ["abc", "def", "g"]), ("abcdef", 3, 0, ["abc", "def"]), ("", 3, 0, []), ("ab", 3, 1, ["ab"]),
    ("abcdefg", 4, 2, ["abcd", "cdef", "efg"]), ("abcdef", 4, 2, ["abcd", "cdef"]), ("äöü", 2, 0, ["äö", "ü"]),
])
def test_chunks_cover_the_text(spark, value, size, overlap, chunks):
    assert one(spark, text.chunk_text(F.lit(value), size, overlap)) == chunks


def test_chunk_arguments():
    with pytest.raises(ValueError):
        text.chunk_text("t", 3, 3)


def test_ascii_clean_reaches_nested_values(spark):
    df = spark.createDataFrame(
        [({"k": ["é1"]}, ("ü2", 3), None)], "m map<string, array<string>>, s struct<a: string, n: int>, z struct<a: string>"
    )
    assert rows(text.ascii_clean_columns(df)) == [({"k": ["1"]}, ("2", 3), None)]


def test_similarity(spark):
    assert one(spark, text.similarity(F.lit(" Café"), F.lit("CAFÉ"))) == 1.0
    assert one(spark, text.similarity(F.lit("東京"), F.lit("北京"))) == 0.5
    assert one(spark, text.similarity(F.lit(""), F.lit("é"))) == 0.0
    assert one(spark, text.similarity(F.lit("abcd"), F.lit("abxd"))) == 0.75


def test_response_schema(spark):
    made = schema.response_schema({"a": "str", "n": "int", "x": {"f": "float", "b": "bool"}, "l": "array"})
    assert made.simpleString() == "struct<a:string,n:bigint,x:struct<f:double,b:boolean>,l:array<string>>"
    for bad in ({}, {"a": "date"}):
        with pytest.raises(ValueError):
            schema.response_schema(bad)
    df = spark.createDataFrame([(("x", None),)], T.StructType([T.StructField("r", schema.response_schema({"a": "str", "b": "int"}))]))
    assert df.select(schema.missing_fields(F.col("r"), {"a": "str", "b": "int"})).first()[0] == ["b"]


def test_required_fields(spark):
    df = spark.createDataFrame([(None, "e")], "error_message string, error_sql string")
    assert templates.require_or_default(df, ["error_sql"], ["error_message", "schema"]).first().asDict() == {
        "error_message": "Not provided", "error_sql": "e", "schema": "Not provided"}
    with pytest.raises(ValueError, match="sub_question"):
        templates.require_or_default(df, ["sub_question"], [])
    with pytest.raises(ValueError):
        templates.fill_sql_inputs(df, "s")


def test_answer_texts(spark):
    none = F.lit(None).cast("string")
    assert one(spark, templates.product_answer_text(F.lit(1), F.lit("N/A"), F.lit("d"))) == "Product ID: 1\nDescription: d"
    assert one(spark, templates.value_answer_text(F.lit(1.5), none, none)) == "Unknown units\n"
    assert one(spark, templates.value_answer_text(none, F.lit("m"), none)) == "Unknown value\n"
    assert one(spark, templates.value_answer_text(F.lit(1.5), F.lit("m"), F.lit("N/A"))) == "Value: 1.5 m\n"
    assert one(spark, templates.code_answer_text(none, F.lit("a"))) == "Unknown code\n"


def test_choice_fallback(spark):
    assert one(spark, templates.choice_answer(F.lit(" B "))) == "(B)"
    assert one(spark, templates.choice_answer(F.lit(None).cast("string"))) == "(A)"


def test_lineage_is_set_once(spark):
    df = records.keep_origin(spark.createDataFrame([("p", 1)], "prompt string, a int"), data=["a"])
    again = records.keep_origin(df.withColumn("prompt", F.lit("q")).withColumn("a", F.lit(2)), data=["a"])
    assert again.select("prompt", "orig_prompt", "orig_data.a").first() == ("q", "p", 1)


def test_response_fields_overwrite_columns(spark):
    df = spark.createDataFrame([(1, (2, "x"))], "a int, response struct<a: int, b: string>")
    assert records.merge_response(df, "s").select("a", "b", "s_output.a").first() == (2, "x", 2)


def test_specs_are_complete():
    for spec in SPECS.values():
        assert spec.inputs and schema.response_schema(spec.output_type)
    assert SPECS["sql_debugger"].before is not None and SPECS["factuality"].validator


def test_validator_spec():
    spec = validator_spec("v", "Check {x}", {}, metadata=("lang",))
    assert spec.inputs == ("x", "lang") and spec.output_type == {"is_valid": "bool"}
    with pytest.raises(ValueError):
        validator_spec("v", "Check {x}", {"is_valid": "str"})


def test_spec_needs_its_columns(spark):
    with pytest.raises(ValueError, match="question"):
        PromptSpec("s", "{question}", {"a": "str"}).prepare(spark.range(1))


@pytest.mark.parametrize("message, kind", [
    ("SYNTAX ERROR in column x does not exist", "syntax_error"), ("Column x does not exist", "missing_column"),
    ("invalid identifier 'X'", "invalid_identifier"), ("schema s does not exist", "schema_error"),
    ("function f does not exist", "function_error"), ("needs group by", "group_by_error"), ("timeout", "other"), ("", "other"),
])
def test_error_types(spark, message, kind):
    assert one(spark, evaluate.sql_error_type(F.lit(message))) == kind


def test_sql_features(spark):
    df = spark.createDataFrame([("select a from (select 1)",), ("WITH t AS (SELECT MAX(x)) SELECT 1 GROUP BY 2",), (None,)], "generated_sql string")
    assert dict(rows(evaluate.sql_features(df))) == {"join": 0, "cte": 1, "subquery": 2, "group_by": 1, "aggregation": 1}


def test_sql_validity(spark):
    df = spark.createDataFrame([(None,), ("",), (" \n",), (" a",), ("b;",)], "q string")
    got = [tuple(r[0]) for r in df.select(evaluate.sql_validity(F.col("q"))).collect()]
    assert [g[0] for g in got] == [False, False, False, True, True]
    assert [g[1] for g in got] == ["No SQL query provided"] * 2 + ["Empty SQL query", None, None]
    assert [g[3] for g in got][3:] == ["a;", "b;"]


def test_task_names():
    assert evaluate.task_names(["all"]) == ["mmlu", "truthfulqa", "earnings", "products", "icd11"]
    assert evaluate.task_names(["products", "x"]) == ["products"]


def test_empty_evaluation_is_an_error(spark):
    with pytest.raises(ValueError):
        evaluate.require_rows(spark.range(0), "products")
