"""Prompt specifications: which columns a step reads, which fields it returns and how they are reshaped.

The wording is this library's own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.functions.templates import (
    CHOICE_TEMPLATE, JUDGE_TEMPLATE, TRUTHFUL_TEMPLATE, fill_sql_inputs, render, require_columns, require_or_default,
    template_keys, with_role,
)
from promptloom.functions.text import terminate_sql
from promptloom.operators.inference import Model, generate, parse_response
from promptloom.operators.records import merge_response, snapshot_input
from promptloom.operators.reshape import collect_questions, explode_concepts, glossary_entries
from promptloom.storage import materialise

Hook = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class PromptSpec:
    name: str
    instruction: str
    output_type: Mapping[str, str]
    role: str = ""
    before: Hook | None = None
    after: Hook | None = None
    validator: bool = False
    verdict: str | None = None
    inputs: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "inputs", tuple(template_keys(self.instruction)))

    @property
    def verdict_field(self) -> str:
        """The boolean output that says whether a record is valid: the named one, else the only one."""
        booleans = [self.verdict] if self.verdict else [f for f, t in self.output_type.items() if t in ("bool", "boolean")]
        if len(booleans) != 1:
            raise ValueError(f"validator {self.name} must name its verdict among {booleans}")
        return booleans[0]

    def prompt(self, columns) -> Column:
        return with_role(self.role, render(self.instruction, columns))

    def prepare(self, df: DataFrame) -> DataFrame:
        """Input snapshot and prompt; no model call."""
        if self.before is not None:
            df = df.transform(self.before)
        require_columns(df, self.inputs, self.name)
        return snapshot_input(df, self.name, self.inputs).withColumn("prompt", self.prompt(df.columns))

    def apply(self, df: DataFrame, model: Model, **options) -> DataFrame:
        """Prepare, call the model, parse, merge the fields and reshape. Records without an answer drop out."""
        return self._finish(generate(self.prepare(df), model, **options))

    def run(self, df: DataFrame, model: Model, **options) -> DataFrame:
        """``apply`` with the model's answers stored. Prompt, input snapshot and parsed fields are not written: they follow from what is, and a reader
        that leaves them out never computes them."""
        called = generate(self.prepare(df), model, **options)
        if {"prompt", "response", "error", "attempts"} & {*self.inputs}:  # overwritten, so they cannot be rendered again
            return self._finish(materialise(called, self.name))
        kept = materialise(called.drop("prompt", f"{self.name}_input"), self.name)
        rebuilt = snapshot_input(kept, self.name, self.inputs).withColumn("prompt", self.prompt(kept.columns))
        return self._finish(rebuilt.select(*called.columns))

    def _finish(self, called: DataFrame) -> DataFrame:
        merged = merge_response(parse_response(called, self.output_type).filter("parse_ok"), self.name)
        return merged.transform(self.after) if self.after is not None else merged


def validator_spec(name: str, instruction: str, output_type: Mapping[str, str], is_valid_field: str = "is_valid",
                   metadata: tuple[str, ...] = (), **rest) -> PromptSpec:
    """A spec whose output always has a boolean verdict; ``metadata`` columns are appended to the prompt."""
    if output_type.get(is_valid_field, "bool") not in ("bool", "boolean"):
        raise ValueError(f"{is_valid_field} must be boolean")
    shown = "".join(f"\n{key}: {{{key}}}" for key in metadata)
    return PromptSpec(name, instruction + shown, {**output_type, is_valid_field: "bool"}, validator=True, verdict=is_valid_field, **rest)


def _terminated(column: str) -> Hook:
    return lambda df: df.withColumn(column, terminate_sql(F.col(column)))


def _questions(key: str, *fields: str) -> Hook:
    return lambda df: df.withColumn(key, collect_questions(fields))


_CONTEXT = "Question: {question}\nSQL: {sql}\nSchema: {schema}\nGlossary: {glossary}\n"


def _question_spec(name: str, ask: str, key: str, n: int = 2) -> PromptSpec:
    fields = [f"q{i}" for i in range(1, n + 1)]
    return PromptSpec(
        name, _CONTEXT + f"{ask} Return JSON with {', '.join(fields)}.", {f: "str" for f in fields},
        role="You write questions that a data analyst could answer with one SQL query.", after=_questions(key, *fields),
    )


SPECS = {
    s.name: s
    for s in [
        PromptSpec("questions_to_concepts", "List the business concepts these questions share, as [a, b, c].\n{questions}",
                   {"concepts_list": "str"}, after=explode_concepts),
        PromptSpec("question_to_concept", "Name the business concept behind this question.\n{question}", {"concept": "str"}),
        PromptSpec("concept_to_sql", "Write the SQL expression that computes this concept.\n{concept}", {"sql": "str"}),
        PromptSpec("schema_to_sql",
                   "Schema: {schema}\nGlossary: {glossary}\nOriginal question: {original_question}\n"
                   "Original SQL: {original_sql}\nWrite one SQL query that answers: {question}",
                   {"sql_query": "str"}, role="You are a SQL engineer.",
                   before=lambda df: fill_sql_inputs(df, "Not provided"), after=_terminated("sql_query")),
        PromptSpec("sql_debugger",
                   "The query below fails.\nQuestion: {sub_question}\nSQL: {error_sql}\nError: {error_message}\n"
                   "Explanation: {error_explanation}\nSchema: {schema}\nGlossary: {glossary}\nReturn a corrected query.",
                   {"corrected_sql": "str"}, role="You are a SQL engineer.",
                   before=lambda df: require_or_default(
                       df, ["sub_question", "error_sql"], ["error_message", "error_explanation", "schema", "glossary"]),
                   after=_terminated("corrected_sql")),
        _question_spec("comparative_questions", "Ask two questions that compare groups, periods or conditions.", "comps"),
        _question_spec("edge_case_questions", "Ask two questions about outliers, rare values or limits.", "edges"),
        _question_spec("granular_questions", "Ask one summary question and one detailed question.", "grans"),
        _question_spec("paraphrases", "Say the question in two other ways without changing its answer.", "paraphrases"),
        _question_spec("pattern_questions", "Ask two other questions whose SQL has the same structure.", "variations"),
        _question_spec("variations", "Change dates, filters, aggregation or grouping to get two new questions.", "variations"),
        _question_spec("question_decomposer", "Split the question into up to three simpler ones.", "sub_questions", 3),
        PromptSpec("glossary",
                   "Schema: {schema}\nQueries: {queries}\nGlossary so far: {input_glossary}\n"
                   "List further terms as a JSON array of objects with the keys input and output.",
                   {"glossary": "string"},
                   after=lambda df: df.withColumn("glossary_entries", glossary_entries(F.col("glossary"), F.col("input_glossary")))),
        PromptSpec("topic_analyzer",
                   "Question: {question}\nSchema: {schema}\nGlossary: {glossary}\nName its topics, kind of analysis and metrics.",
                   {"topics": "array", "analysis_type": "str", "metrics": "array"}),
        PromptSpec("gap_analyzer",
                   "Topics wanted: {gold_topics}\nTopics covered: {generated_topics}\nMissing: {missing_topics}\n"
                   "Schema: {schema}\nGlossary: {glossary}\nWrite {num_questions} questions on the missing topics.",
                   {"questions": "array", "topics_covered": "array"}),
        PromptSpec("sql_failure_analysis", "Statistics: {basic_stats}\nExamples: {sample_queries}\nExplain the main causes.",
                   {"analysis": "str"}),
        PromptSpec("sql_result_analyzer",
                   "Question: {question}\nQuery A: {gold_query}\nQuery B: {generated_query}\nResult A: {gold_result}\n"
                   "Result B: {generated_result}\nDo both answer the question equally?",
                   {"equivalent": "bool", "confidence": "float", "explanation": "str", "differences": "array"}),
        PromptSpec("document_questions", "{question_task}\nWrite {num_questions} questions on this text.\n{chunk}", {"questions": "array"}),
        PromptSpec("document_answer", "{answer_task}\nText: {chunk}\nQuestion: {question}", {"answer": "str"}),
        PromptSpec("sql_questions", "{question_task}\nSchemas: {schemas}\nExamples: {seed_questions}\nWrite {num_questions} questions.",
                   {"questions": "array"}),
        PromptSpec("sql_answer", "{query_task}\nSchemas: {schemas}\nQuestion: {question}", {"sql_query": "str"},
                   after=_terminated("sql_query")),
        PromptSpec("example_generator",
                   "Examples so far:\n{examples}\nDescription:\n{description}\nSummarise five different examples of it, each in at "
                   "most ten words.", {f"example_{i}": "str" for i in range(1, 6)}),
        PromptSpec("example_modifier",
                   "Existing summaries:\n{summaries}\nWrite five more that differ clearly from them, each in at most ten words.",
                   {f"example_{i}": "str" for i in range(1, 6)}),
        PromptSpec("example_expander",
                   "Description:\n{description}\nSummary of one example:\n{summary}\nWrite the whole example.", {"output": "str"}),
        validator_spec("factuality", "Think step by step, then say whether the answer is factual.\nQuestion: {question}\nAnswer: {answer}",
                       {"thinking_steps": "str"}, is_valid_field="is_factual"),
        validator_spec("sql_score", "Are the results of these queries similar?\nA: {gold_query}\nB: {generated_query}",
                       {"explanation": "str"}, is_valid_field="is_similar"),
        PromptSpec("product_answer", "Help a customer find a product. Give its name, id and description.\n{question}",
                   {"product_name": "str", "product_description": "str", "product_id": "int"}),
        PromptSpec("earnings_answer",
                   "Answer a client's question on an earnings call.\nDate: {date}\nTicker: {ticker}\nQuarter: {q}\n{question}",
                   {"answer": "str", "value": "float", "units": "str"}),
        PromptSpec("code_answer", "Answer with the most fitting medical code.\n{question}", {"answer": "str", "icd11_code": "str"}),
        PromptSpec("judge", JUDGE_TEMPLATE, {"explanation": "str", "score": "int"}),
        PromptSpec("multiple_choice", CHOICE_TEMPLATE, {"explanation": "str", "answer": "str"}),
        PromptSpec("truthfulness", TRUTHFUL_TEMPLATE, {"answer": "str"}),
    ]
}
