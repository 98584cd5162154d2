"""Prompt templates compiled on the driver into ``concat`` expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLOT = re.compile(r"\{(.*?)\}")

# Prompt formats of the supported chat model families and their default system text.
CHAT_TEMPLATES = {
    "llama2": "<s>[INST] <<SYS>>\n{system}\n<</SYS>>\n\n{user} [/INST]",
    "llama3": (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n{system}<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\n{user}<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n"
    ),
    "mistral": "<s>[INST] {system} {user} [/INST]",
    "plain": "{user}",
}
DEFAULT_SYSTEM_PROMPT = (
    "You are a helpful, respectful and honest assistant. Always answer as helpfully as possible, while being safe.  "
    "Your answers should not include any harmful, unethical, racist, sexist, toxic, dangerous, or illegal content. "
    "Please ensure that your responses are socially unbiased and positive in nature.\n\n"
    "If a question does not make any sense, or is not factually coherent, explain why instead of answering something "
    "not correct. If you don't know the answer to a question, please don't share false information."
)
MISTRAL_SYSTEM_PROMPT = (
    "Always assist with care, respect, and truth. Respond with utmost utility yet securely. Avoid harmful, unethical, "
    "prejudiced, or negative content. Ensure replies promote fairness and positivity."
)
# What replaces an absent value, and a failed multiple-choice answer.
NOT_PROVIDED = "Not provided"
FALLBACK_CHOICE = "(A)"


def template_keys(template: str) -> list[str]:
    """Slot names in order of first appearance."""
    return list(dict.fromkeys(_SLOT.findall(template)))


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> None:
    """Fail before any job runs when a column is absent."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"{what} needs column(s) {absent}; available: {df.columns}")


def render(template: str, values: Mapping[str, Column] | Sequence[str], null_text: str = "None") -> Column:
    """Replace each slot by the row's value; a null value shows as ``null_text``.

    ``values`` maps slot names to columns, or lists the available column names.
    """
    if not isinstance(values, Mapping):
        values = {name: F.col(f"`{name}`") for name in values}
    absent = [k for k in template_keys(template) if k not in values]
    if absent:
        raise ValueError(f"template needs {absent}; available: {sorted(values)}")
    parts, at = [], 0
    for slot in _SLOT.finditer(template):
        if slot.start() > at:
            parts.append(F.lit(template[at : slot.start()]))
        parts.append(F.coalesce(values[slot.group(1)].cast("string"), F.lit(null_text)))
        at = slot.end()
    if at < len(template) or not parts:
        parts.append(F.lit(template[at:]))
    return F.concat(*parts)


def with_role(role: str | None, prompt: Column) -> Column:
    return F.concat(F.lit(f"{role}\n\n"), prompt) if role else prompt


def chat_prompt(style: str, user: Column, system: Column | None = None, default_system: str | None = None) -> Column:
    """Chat format of ``style``; an empty or null system text falls back to the default of the style."""
    if default_system is None:
        default_system = MISTRAL_SYSTEM_PROMPT if style == "mistral" else DEFAULT_SYSTEM_PROMPT
    given = F.lit(None).cast("string") if system is None else system
    return render(
        CHAT_TEMPLATES[style],
        {"user": user, "system": F.coalesce(F.nullif(given, F.lit("")), F.lit(default_system))},
        null_text="",
    )


def sectioned_prompt(sections: Sequence[tuple[str, Column]], separator: str = "\n") -> Column:
    """Instruction, separator, value, separator for each section; null values are empty."""
    parts = []
    for instruction, value in sections:
        parts += [F.lit(instruction + separator), F.coalesce(value.cast("string"), F.lit("")), F.lit(separator)]
    return F.concat(*parts)


def line_unless_na(label: str, value: Column, end: str = "\n") -> Column:
    """``label: value`` as a line, or nothing when the value is null or ``N/A``."""
    text = value.cast("string")
    return F.when(text.isNotNull() & (text != "N/A"), F.concat(F.lit(f"{label}: "), text, F.lit(end))).otherwise("")


def product_answer_text(product_id: Column, name: Column, description: Column) -> Column:
    return F.concat(
        F.lit("Product ID: "), product_id.cast("string"), F.lit("\n"),
        line_unless_na("Product Name", name), line_unless_na("Description", description, end=""),
    )


def value_answer_text(value: Column, units: Column, answer: Column) -> Column:
    """Text of a value answer; a missing field is named instead."""
    return (
        F.when(units.isNull(), "Unknown units\n")
        .when(value.isNull(), "Unknown value\n")
        .otherwise(F.concat(F.lit("Value: "), value.cast("string"), F.lit(" "), units, F.lit("\n"),
                            line_unless_na("Answer", answer)))
    )


def code_answer_text(code: Column, answer: Column, label: str = "ICD11 Code") -> Column:
    return F.when(code.isNull(), "Unknown code\n").otherwise(
        F.concat(F.lit(f"{label}: "), code, F.lit("\n"), line_unless_na("Answer", answer))
    )


JUDGE_TEMPLATE = (
    "Compare a model's answer with the reference answer and grade it.\n{rubric}\n"
    "Reply with JSON holding a short `explanation` and an integer `score`.\n\n"
    "### question\n{question}\n\n### reference answer\n{gold}\n\n### model answer\n{answer}\n"
)
CHOICE_TEMPLATE = (
    "Answer the multiple-choice question. Reply with JSON holding a brief `explanation` and the "
    "chosen option as `answer`.\n\n### question\n{question}\n"
)
TRUTHFUL_TEMPLATE = (
    "Answer truthfully and informatively in one or two sentences. Use the worked examples only as a "
    "guide and answer the last question.\n\n### question\n{question}\n"
)


def judge_prompt(rubric: str, question: Column, gold: Column, answer: Column) -> Column:
    return render(JUDGE_TEMPLATE, {"rubric": F.lit(rubric), "question": question, "gold": gold, "answer": answer})


def choice_answer(answer: Column) -> Column:
    """``(answer)`` with the answer trimmed; a failed request falls back to a fixed choice."""
    return F.coalesce(F.concat(F.lit("("), F.trim(answer), F.lit(")")), F.lit(FALLBACK_CHOICE))


def fill_defaults(df: DataFrame, defaults: Mapping[str, Column | str | None]) -> DataFrame:
    """Null or absent columns take their default, in mapping order, so one may build on another."""
    for name, default in defaults.items():
        value = default if isinstance(default, Column) else F.lit(default)
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df


def fill_sql_inputs(df: DataFrame, schema: str) -> DataFrame:
    """Inputs of SQL generation: the question may arrive as ``sub_question``; the rest gets defaults."""
    source = [F.col(c) for c in ("question", "sub_question") if c in df.columns]
    if not source:
        raise ValueError("SQL generation needs a question or sub_question column")
    question = F.coalesce(*source)
    return fill_defaults(
        df.withColumn("question", question),
        {"original_question": F.col("question"), "original_sql": "", "glossary": "", "schema": schema},
    )


def require_or_default(df: DataFrame, required: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """Required columns must exist; optional ones show a fixed text when absent or null."""
    require_columns(df, required, "this step")
    return fill_defaults(df, {name: NOT_PROVIDED for name in optional})
