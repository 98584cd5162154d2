"""End-to-end jobs, with deterministic doubles for the models."""

import json
import re

import pandas as pd
from pyspark.sql import functions as F

from promptloom.operators import compare, evaluate
from promptloom.plans import experiments as ex
from promptloom.plans.specs import SPECS
from promptloom.plans.steps import AgenticRun
from promptloom.registry import retrieval
from promptloom.registry.aggregates import sql_errors
from promptloom.registry.base import ORACLES, embedded_sql, prompts, query, squared_distance_sql
from promptloom.storage import scratch_path
from promptloom.testing.doubles import json_model, letter_encoder


def _number(prompt):
    return int(re.search(r"#(\d+)", prompt).group(1))


def grading_model():
    """Grades 5 when the model answer equals the reference answer, else 3."""

    def predict(asked: pd.Series) -> pd.Series:
        def grade(p):
            gold, answer = p.split("### reference answer\n", 1)[1].split("\n\n### model answer\n", 1)
            return json.dumps({"explanation": "", "score": 5 if gold.strip() == answer.strip() else 3})

        return asked.map(grade)

    return predict


_PRODUCTS = "SELECT p_partkey AS id, p_partkey % 10 <> 0 AS is_exact_match, CAST(CASE WHEN p_partkey % 10 <> 0 THEN 5 ELSE 3 END AS BIGINT) AS score FROM part"


def product_questions(t):
    return t.part.select(
        F.concat(F.lit("Find #"), F.col("p_partkey")).alias("question"), F.col("p_partkey").alias("product_id"),
        F.lit("ring").alias("product_name"), F.lit("N/A").alias("description"),
    )


def product_model():
    return json_model(
        product_name=lambda p: "ring", product_description=lambda p: "N/A", product_id=lambda p: _number(p) + (_number(p) % 10 == 0)
    )


@query("evaluate_products", _PRODUCTS)
def evaluate_products(t):
    """Every part is a question; the double names the wrong id for every tenth one."""
    out = ex.judge_answers(ex.TASKS["products"], product_questions(t), product_model(), grading_model, batch_size=64)
    return out.select(F.col("expected_product_id").alias("id"), "is_exact_match", "score")


@query("evaluate_values", """
SELECT l_orderkey, l_linenumber, l_quantity < 40 AS is_exact_match, CAST(CASE WHEN l_quantity < 40 THEN 5 ELSE 3 END AS BIGINT) AS score FROM lineitem""")
def evaluate_values(t):
    """Every line item is a question on its quantity; the double never answers more than 39."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("Quantity #"), F.col("l_quantity").cast("int")).alias("question"), F.col("l_quantity").alias("value"),
        F.lit("pieces").alias("units"), F.lit("N/A").alias("answer"), F.lit("2024-01-01").alias("date"), F.lit("TICK").alias("ticker"), F.lit("Q1").alias("q"),
    )
    model = json_model(answer=lambda p: "N/A", value=lambda p: float(min(_number(p), 39)), units=lambda p: "pieces")
    out = ex.judge_answers(ex.TASKS["earnings"], rows, model, grading_model, batch_size=256)
    return out.select("l_orderkey", "l_linenumber", "is_exact_match", "score")


@query("evaluate_codes", """
SELECT s_suppkey, s_nationkey < 20 AS is_exact_match, CAST(CASE WHEN s_nationkey < 20 THEN 5 ELSE 3 END AS BIGINT) AS score FROM supplier""")
def evaluate_codes(t):
    """Every supplier is a question on its nation's code; the double knows the first twenty."""
    code = F.concat(F.lit("N"), F.col("s_nationkey"))
    rows = t.supplier.select(
        "s_suppkey", F.concat(F.lit("Code of #"), F.col("s_nationkey")).alias("question"), F.lit("N/A").alias("answer"),
        F.struct(code.alias("code"), F.lit("nation").alias("title")).alias("entity"),
    )
    model = json_model(answer=lambda p: "N/A", icd11_code=lambda p: f"N{_number(p)}" if _number(p) < 20 else None)
    out = ex.judge_answers(ex.TASKS["icd11"], rows, model, grading_model, batch_size=64)
    return out.select("s_suppkey", "is_exact_match", "score")


@query("run_evaluation", f"""
SELECT 0 AS metric_no, 'product_response_subjective_score' AS metric, round(avg(score), 6) AS value FROM ({_PRODUCTS})
UNION ALL SELECT 1, 'product_id_precision_score', round(avg(CAST(is_exact_match AS INT)), 6) FROM ({_PRODUCTS})
UNION ALL SELECT 2, 'earnings_response_subjective_score', -1.0 UNION ALL SELECT 3, 'earnings_precision_score', -1.0
UNION ALL SELECT 4, 'icd11_response_subjective_score', -1.0 UNION ALL SELECT 5, 'icd11_precision_score', -1.0""")
def run_evaluation(t):
    scores = ex.run_evaluation({"products": product_questions(t)}, ["products", "unknown"], product_model(), grading_model, batch_size=64)
    return evaluate.summarise(scores).withColumn("value", F.round("value", 6))


_CHUNKS = """SELECT doc_id, i AS chunk_no, substring(text, CAST(i * 1024 + 1 AS BIGINT), 1024) AS chunk FROM (
  SELECT doc_id, text, unnest(range(CAST(ceil(length(text) / 1024.0) AS BIGINT))) AS i FROM documents)"""


def _chunk_of(prompt):
    return prompt.split("questions on this text.\n", 1)[1]


@query("document_questions", f"""
SELECT doc_id, CAST(chunk_no AS INT) AS chunk_no, question_no, question, 'A' || length(question) AS answer FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(question) ORDER BY doc_id, chunk_no, question_no) AS r FROM (
    SELECT doc_id, chunk_no, 0 AS question_no, 'How long: ' || length(chunk) AS question FROM ({_CHUNKS})
    UNION ALL SELECT doc_id, chunk_no, 1, 'What starts ' || md5(chunk) FROM ({_CHUNKS}))) WHERE r = 1 AND length(question) > 20""")
def document_questions(t):
    """Two questions a chunk, repeated ones dropped; the validator rejects answers to short questions."""
    import hashlib

    def questions(p):
        chunk = _chunk_of(p)
        return [f"How long: {len(chunk)}", f"What starts {hashlib.md5(chunk.encode()).hexdigest()}", "never asked"]

    def asks(p):
        return "questions on this text.\n" in p

    model = json_model(
        questions=lambda p: questions(p) if asks(p) else [],
        answer=lambda p: "" if asks(p) else f"A{len(p.rsplit('Question: ', 1)[1])}",
        thinking_steps=lambda p: "", is_factual=lambda p: "whether the answer" in p and int(p.rsplit("Answer: A", 1)[1]) > 20,
    )
    return ex.document_questions(t.documents, model, num_questions=2, dedupe=True, validate_answers=True, batch_size=64)


@query("sql_questions", """
SELECT p_partkey AS request_id, 0 AS question_no, 'Size of ' || p_partkey AS question, 'SELECT ' || length('Size of ' || p_partkey) || ';' AS sql_query FROM part
UNION ALL SELECT min(p_partkey), 1, 'Count ' || p_type, 'SELECT ' || length('Count ' || p_type) || ';' FROM part GROUP BY p_type""")
def sql_questions(t):
    rows = t.part.select(
        F.col("p_partkey").alias("request_id"), F.concat_ws("|", F.lit("part"), "p_type", "p_partkey").alias("schemas"),
        F.lit("none").alias("seed_questions"), F.lit("Ask.").alias("question_task"), F.lit("Query.").alias("query_task"),
    )

    def questions(p):
        _, kind, key = re.search(r"Schemas: (.*)", p).group(1).split("|")
        return [f"Size of {key}", f"COUNT   {kind}" if int(key) % 2 else f"Count {kind}", f"Blank {key}"]

    def answer(p):
        asked = re.search(r"Question: (.*)", p)
        return "" if asked is None or asked.group(1).startswith("Blank") else f"SELECT {len(re.sub(r' +', ' ', asked.group(1)))}"

    model = json_model(questions=lambda p: questions(p) if "Write" in p else [], sql_query=answer)
    out = ex.sql_questions(rows, model, batch_size=64)
    return out.withColumn("question", F.regexp_replace(F.regexp_replace("question", " +", " "), "^COUNT", "Count"))


@query("topic_gap_questions", f"""
SELECT batch, CAST(i AS INT) AS pair_no, 'About ' || string_split(topics, ',')[1] || ' ' || i AS question, string_split(topics, ',')[1] AS covered_topics, gold AS gold_topics, generated AS generated_topics FROM (
  SELECT batch, topics, gold, generated, unnest(range(num_questions - 1)) AS i FROM ({ORACLES["topic_batches"]}))""")
def topic_gap_questions(t):
    """The double writes one question less than asked for, all on the first topic of the batch."""
    def first(p):
        return p.split("\nMissing: ", 1)[1].split("\nSchema: ", 1)[0].split(",")[0]

    def wanted(p):
        return int(re.search(r"Write (\d+) questions", p).group(1))

    model = json_model(
        questions=lambda p: [f"About {first(p)} {i}" for i in range(wanted(p) - 1)], topics_covered=lambda p: [first(p)] * wanted(p)
    )
    return ex.fill_topic_gaps(retrieval.coverage(t), model, "documents(text)", "", batch_size=64)


@query("analyse_topics", """
SELECT topic, count(*) AS n FROM (SELECT unnest([lang, source]) AS topic FROM documents) GROUP BY topic""")
def analyse_topics(t):
    rows = t.documents.select(F.concat_ws("/", "lang", "source").alias("question"))

    def parts(p):
        return re.search(r"Question: (.*)", p).group(1).split("/")

    model = json_model(topics=parts, analysis_type=lambda p: "count", metrics=lambda p: [])
    return evaluate.topic_counts(ex.analyse_topics(rows, model, "documents", "", batch_size=64))


@query("failure_analysis", f"""
SELECT prompt, 'seen ' || length(prompt) AS analysis FROM (SELECT 'Statistics: ' || regexp_replace(prompt, '\\n\\nQuery 1\\n', chr(10) || 'Examples: Query 1' || chr(10))
  || chr(10) || 'Explain the main causes.' AS prompt FROM ({ORACLES['failure_digest']}))""")
def failure_analysis(t):
    return ex.explain_failures(sql_errors(t), "event_id", json_model(analysis=lambda p: f"seen {len(p)}"))


@query("sql_pair_judged", f"""
SELECT case_no, status, equivalent, CASE WHEN status = 'success' AND NOT equivalent THEN 0.9 ELSE confidence END AS confidence FROM ({ORACLES["sql_pair_eval"]})""")
def sql_pair_judged(t):
    """The judge double sees how many rows only the gold result has, and is sure that any make a difference."""
    retrieval.register_tables(t)
    model = json_model(
        equivalent=lambda p: "Result A: 0 rows" in p, confidence=lambda p: 0.9, explanation=lambda p: "judged", differences=lambda p: []
    )
    out = compare.evaluate_sql_pairs(t.spark, retrieval.CASES, 2, ex.judge_results(model))
    return out.select("case_no", "status", "equivalent", "confidence")


_RECORDS = "SELECT doc_id, 'Question: ' || text || chr(10) || 'Concept: ' || substring(text, 1, 3) || chr(10) AS split FROM documents"


@query("memory_experiment", f"""
WITH r AS ({_RECORDS}), d AS ({embedded_sql("r", "doc_id", "split")}), b AS ({embedded_sql("benchmark", "item_id", "text")}),
h AS (SELECT b.item_id, d.split, {squared_distance_sql('b.e', 'd.e')} AS distance FROM b, d)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY distance, split) AS INT) AS rank, round(distance, 6) AS distance
FROM h QUALIFY rank <= 3""")
def memory_experiment(t):
    """Records of a one-step run over every document are indexed; every benchmark text asks for the closest three."""
    run = AgenticRun({"question_to_concept": SPECS["question_to_concept"]}, {}, json_model(concept=lambda p: p.split("\n", 1)[1][:3]))
    memory = ex.MemoryExperiment(run, letter_encoder, scratch_path(t.spark, "memory"))
    memory(prompts(t).select("prompt_id", F.col("prompt").alias("question")))
    hits = memory.similar(t.benchmark.select("item_id", F.col("text").alias("prompt")), 3, query_id="item_id")
    return hits.select("item_id", "rank", F.round("distance", 6).alias("distance"))


@query("augment_with_model", """
SELECT lang AS class_name, text AS example, false AS is_new FROM documents
UNION ALL SELECT lang, 'whole ' || CASE WHEN i % 10 < 5 THEN 'other ' ELSE 'short ' END || (i % 5 + 1) || ' of ' || lang, true FROM (
  SELECT lang, unnest(range(0, n)) AS i FROM (SELECT lang, greatest(CAST((SELECT max(c) FROM (SELECT count(*) AS c FROM documents GROUP BY lang)) AS BIGINT) - count(*), 0) AS n
  FROM documents GROUP BY lang))""")
def augment_with_model(t):
    """Every language is a class to be filled up to the size of the largest one; one request makes ten examples, and rounds go on until none lacks any."""
    from promptloom.operators import classify

    examples = t.documents.select(F.col("lang").alias("class_name"), F.col("text").alias("example"))
    descriptions = examples.select("class_name").distinct().withColumn("description", F.concat(F.lit("lang="), F.col("class_name")))
    target = examples.groupBy("class_name").count().agg(F.max("count")).first()[0]

    def made(i):
        def value(p):
            if p.startswith("Existing"):
                return f"other {i} of " + re.search(r" of (\w+)", p).group(1)
            return f"short {i} of " + re.findall(r"Description:\nlang=(\w+)", p)[-1] if "Summarise" in p else ""
        return value

    def whole(p):
        summary = re.search(r"Summary of one example:\n(.*)\n", p)
        return f"whole {summary.group(1)}" if summary else ""

    model = json_model(**{f"example_{i}": made(i) for i in range(1, 6)}, output=whole)
    return classify.augment_examples(
        examples, target, lambda turn, current: ex.example_round(descriptions, current, model, turn, batch_size=64))
