"""End-to-end jobs composed of the operators and prompt specifications."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptloom.functions import templates as tpl
from promptloom.functions.text import chunk_rows, question_key
from promptloom.operators import evaluate, records, reshape
from promptloom.operators import retrieval as ret
from promptloom.operators.classify import EmbeddingClassifier, Round, augment_examples, class_registry, few_shot, small
from promptloom.operators.inference import Model, embed, generate, spread
from promptloom.plans.specs import SPECS
from promptloom.plans.steps import AgenticRun
from promptloom.storage import materialise

# Defaults of document and SQL question generation.
NUM_QUESTIONS = 3
CHUNK_SIZE = 1024


# Evaluation of answers

@dataclass(frozen=True)
class EvalTask:
    """What one evaluation task asks, how its answers read and when they match."""

    name: str
    answer_spec: str
    prepare: Callable[[DataFrame], DataFrame]
    gold: Callable[[], Column]
    answer: Callable[[], Column]
    match: Callable[[], Column]
    rubric: str


_SCALE = (
    "5: the {key} agrees, even if other fields are missing. 4: the answer says the same but the {key} may be off. "
    "3: the answer is similar. 2: the answer differs but is plausible. 1: the answer makes no sense."
)


def _col(name: str) -> Column:
    return F.col(name)


TASKS = {
    task.name: task
    for task in [
        EvalTask(
            "products", "product_answer", lambda df: records.rename_expected(df, ["product_id", "product_name"]),
            lambda: tpl.product_answer_text(_col("expected_product_id"), _col("expected_product_name"), _col("description")),
            lambda: tpl.product_answer_text(_col("product_id"), _col("product_name"), _col("product_description")),
            lambda: evaluate.all_equal((_col("product_id"), _col("expected_product_id"))),
            _SCALE.format(key="product id"),
        ),
        EvalTask(
            "earnings", "earnings_answer", lambda df: records.rename_expected(df, ["value", "units", "answer"]),
            lambda: tpl.value_answer_text(_col("expected_value"), _col("expected_units"), _col("expected_answer")),
            lambda: tpl.value_answer_text(_col("value"), _col("units"), _col("answer")),
            lambda: evaluate.all_equal((_col("units"), _col("expected_units")), (_col("value"), _col("expected_value"))),
            _SCALE.format(key="value"),
        ),
        EvalTask(
            "icd11", "code_answer",
            lambda df: records.rename_expected(records.lift_field(df, "entity", "code", "icd11_code"), ["icd11_code", "answer"]),
            lambda: tpl.code_answer_text(_col("expected_icd11_code"), _col("expected_answer")),
            lambda: tpl.code_answer_text(_col("icd11_code"), _col("answer")),
            lambda: evaluate.all_equal((_col("icd11_code"), _col("expected_icd11_code"))),
            _SCALE.format(key="code"),
        ),
    ]
}


def judge_answers(task: EvalTask, df: DataFrame, model: Model, judge: Model, **options) -> DataFrame:
    """Answer the questions of a task and grade the answers: adds task, answer text, match and score."""
    answered = SPECS[task.answer_spec].run(task.prepare(df), model, **options)
    shown = answered.withColumns({
        "gold": task.gold(), "answer": task.answer(), "is_exact_match": task.match(), "rubric": F.lit(task.rubric), "task": F.lit(task.name),
    })
    return SPECS["judge"].run(shown, judge, **options)


def run_evaluation(data: Mapping[str, DataFrame], tasks: Sequence[str], model: Model, judge: Model, **options) -> DataFrame:
    """Scores of every known task in ``tasks`` that has data; pass them to ``evaluate.summarise``."""
    names = [n for n in evaluate.task_names(tasks) if n in data and n in TASKS]
    if not names:
        raise ValueError(f"no known task with data among {list(tasks)}")
    parts = [
        evaluate.require_rows(judge_answers(TASKS[n], data[n], model, judge, **options).select("task", "score", "is_exact_match"), n)
        for n in names
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return evaluate.score_tasks(out)


# Question generation

def first_copies(df: DataFrame, question: str, order_by: Sequence[str]) -> DataFrame:
    """Keep the first of the questions that differ only in case and white space. The window keeps one row per
    question in each task before the shuffle, so many copies of one question do not gather."""
    order = Window.partitionBy("_k").orderBy(*order_by)
    keyed = df.withColumn("_k", F.sha2(question_key(F.col(question)), 256))
    return keyed.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r", "_k")


def document_questions(documents: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id", num_questions: int = NUM_QUESTIONS,
                       chunk_size: int = CHUNK_SIZE, dedupe: bool = False, validate_answers: bool = False,
                       question_task: str = "Ask about facts of this text only.", answer_task: str = "Answer from this text only.",
                       **options) -> DataFrame:
    """Questions and answers on the chunks of documents: (doc_id, chunk_no, question_no, question, answer)."""
    chunks = chunk_rows(documents, text, [doc_id], chunk_size).withColumns(
        {"num_questions": F.lit(num_questions), "question_task": F.lit(question_task), "answer_task": F.lit(answer_task)}
    )
    keys = [doc_id, "chunk_no", "question_no"]
    asked = materialise(SPECS["document_questions"].apply(chunks, model, **options), "questions")
    rows = asked.select(
        doc_id, "chunk_no", "chunk", "answer_task",
        F.posexplode(F.slice("questions", 1, num_questions)).alias("question_no", "question"),
    )
    if dedupe:
        rows = first_copies(rows, "question", keys)
    answered = materialise(SPECS["document_answer"].apply(rows, model, **options), "answers")
    if validate_answers:
        answered = materialise(SPECS["factuality"].apply(answered, model, **options).filter("is_factual"), "validated")
    return answered.select(*keys, "question", "answer")


def sql_questions(requests: DataFrame, model: Model, request_id: str = "request_id", num_questions: int = NUM_QUESTIONS, dedupe: bool = True,
                  validate_answers: bool = True, **options) -> DataFrame:
    """Questions and SQL for rows of (request_id, schemas, seed_questions, question_task, query_task)."""
    asked = SPECS["sql_questions"].apply(requests.withColumn("num_questions", F.lit(num_questions)), model, **options)
    # Short requests come from few files; stored in many, so that no task sorts all their questions.
    asked = materialise(spread(asked, request_id), "questions")
    keys = [request_id, "question_no"]
    rows = asked.select(
        request_id, "schemas", "query_task", F.posexplode(F.slice("questions", 1, num_questions)).alias("question_no", "question")
    )
    if dedupe:
        rows = first_copies(rows, "question", keys)
    answered = materialise(SPECS["sql_answer"].apply(rows, model, **options), "answers")
    if validate_answers:
        answered = answered.filter(evaluate.sql_validity(F.regexp_replace("sql_query", ";$", "")).getField("is_valid"))
    return answered.select(*keys, "question", "sql_query")


def analyse_topics(questions: DataFrame, model: Model, schema: str, glossary: str, **options) -> DataFrame:
    """Add topics, analysis type and metrics to each question."""
    asked = questions.withColumn("question", evaluate.question_text(questions)).filter(F.trim("question") != "")
    context = asked.withColumns({"schema": F.lit(schema), "glossary": F.lit(glossary)})
    return materialise(SPECS["topic_analyzer"].apply(context, model, **options), "topics")


def fill_topic_gaps(coverage: DataFrame, model: Model, schema: str, glossary: str, per_topic: int = 2, **options) -> DataFrame:
    """New questions for missing and under-represented topics: (batch, pair_no, question, covered_topics).

    A request names its batch of topics with their counts on both sides. The whole topic lists grow with the questions and do not fit a prompt.
    """
    batches = evaluate.topic_batches(coverage, per_topic).withColumnsRenamed({
        "topics": "missing_topics", "gold": "gold_topics", "generated": "generated_topics"}).withColumns({
        "schema": F.lit(schema), "glossary": F.lit(glossary),
    })
    made = materialise(SPECS["gap_analyzer"].apply(batches, model, **options), "gap-questions")
    pairs = reshape.zip_shortest(made, "questions", "topics_covered", ["batch", "gold_topics", "generated_topics"])
    return pairs.withColumnsRenamed({"questions": "question", "topics_covered": "covered_topics"})


def explain_failures(failed: DataFrame, order_by: str, model: Model) -> DataFrame:
    """One row: the failure analysis prompt over all failures and the model's analysis."""
    return SPECS["sql_failure_analysis"].apply(evaluate.failure_parts(failed, order_by), model).select("prompt", "analysis")


def judge_results(model: Model, **options):
    """A judge for ``compare.evaluate_sql_pairs``."""
    return lambda cases: materialise(SPECS["sql_result_analyzer"].apply(cases, model, **options), "verdicts")


# Retrieval over the records of a run

@dataclass
class MemoryExperiment:
    """An agentic run whose records become an index that later prompts draw on."""

    run: AgenticRun
    encoder: Callable
    index_path: str
    rag_keys: Mapping[str, Sequence[str]] | None = None
    id_cols: Sequence[str] = ("prompt_id",)

    def __call__(self, df: DataFrame) -> DataFrame:
        results = self.run.run(df)
        texts = results.select(*self.id_cols, reshape.record_text(results, self.rag_keys).alias("split"))
        ret.save_index(ret.index_rows(texts, "split", self.encoder, self.id_cols), self.index_path)
        return results

    def index(self, spark: SparkSession) -> ret.StoredIndex:
        found = ret.open_index(spark, self.index_path)
        if found is None:
            raise FileNotFoundError(f"no index at {self.index_path}; run the experiment first")
        return found

    def similar(self, prompts: DataFrame, k: int = 3, **names) -> DataFrame:
        return ret.retrieve(prompts, self.index(prompts.sparkSession), self.encoder, k, **names)

    def answer(self, prompts: DataFrame, model: Model, output_type: Mapping | None = None, k: int = 3, slot: str | None = None, **names) -> DataFrame:
        full = ret.rag_prompts(prompts, self.index(prompts.sparkSession), self.encoder, k, slot=slot, **names)
        return generate(full, model, output_type=output_type)


# Classifiers from descriptions

def example_round(descriptions: DataFrame, examples: DataFrame, model: Model, seed: int = 0, **options) -> Round:
    """A round of ``augment_examples``: short summaries, more diverse ones, then whole examples of both.

    ``descriptions`` has (class_name, description); ``examples`` has (class_name, example). A request makes ten examples, so a class gets
    as many requests as it needs, numbered in their prompts from the second on.
    """
    numbered = F.when(F.col("request") > 1, F.concat("_described", F.lit("\nRequest "), "request", F.lit(": differ from the other requests.")))

    def fill(need: DataFrame) -> DataFrame:
        shots = few_shot(examples.withColumn("_id", F.sha2("example", 256)), "class_name", "_id", "example", seed)
        asked = need.join(descriptions, "class_name").join(small(shots), "class_name", "left").fillna("", ["examples"])
        asked = asked.withColumn("request", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("need") / 10)))).repartition("class_name", "request")
        asked = asked.withColumnRenamed("description", "_described").withColumn("description", F.coalesce(numbered, "_described"))
        first = materialise(SPECS["example_generator"].apply(asked, model, **options), "summaries")
        listed = F.array_join(F.array(*[F.col(f"example_{i}") for i in range(1, 6)]), "\n")
        first = first.withColumn("description", F.col("_described"))
        more = materialise(
            SPECS["example_modifier"].apply(first.select("class_name", "request", "description", listed.alias("summaries")), model, **options), "diverse"
        )
        rows = [
            reshape.unpivot_examples(part, ["class_name", "request", "description"]).withColumn("phase", F.lit(phase))
            for phase, part in enumerate((more, first))
        ]
        summaries = rows[0].unionByName(rows[1]).withColumnRenamed("example", "summary")
        whole = SPECS["example_expander"].apply(summaries, model, **options)
        return whole.select("class_name", F.col("output").alias("example"), F.struct("request", "phase", "example_no").alias("sort_key"))

    return fill


def train_from_descriptions(descriptions: DataFrame, examples: DataFrame, model: Model, encoder: Callable, target: int = 10,
                            position: str | None = None, **options) -> EmbeddingClassifier:
    """Fill each class up to ``target`` examples with generated ones, embed them all and fit a classifier.

    Rounds go on until no class lacks examples; each shows the model some of those made so far. Class ids follow ``position``, or the order
    in which ``descriptions`` first names the classes.
    """
    placed = descriptions.withColumn("_at", F.monotonically_increasing_id() if position is None else F.col(position))
    named = materialise(placed.groupBy("class_name").agg(F.min("_at").alias("position")), "classes")
    make = lambda seed, current: example_round(descriptions, current, model, seed, **options)
    filled = materialise(augment_examples(examples, target, make, classes=named), "examples")
    embedded = materialise(embed(filled, encoder, "example"), "embedded")
    return EmbeddingClassifier.fit(embedded, class_registry(named))
