"""Fan-out and reshaping of model responses; all of it built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.functions.text import strip_fence

GLOSSARY = "array<struct<input: string, output: string>>"


def split_response(df: DataFrame, response: str = "response", prompt: str = "prompt") -> DataFrame:
    """One row per response field (``field``, ``response``); the prompt is emptied and other columns stay.

    The response is a struct or a map; any other kind, or a null one, yields no rows.
    """
    dtype = df.schema[response].dataType
    if isinstance(dtype, T.StructType):
        pairs = F.array(*[
            F.struct(F.lit(f.name).alias("key"), F.col(response).getField(f.name).cast("string").alias("value"))
            for f in dtype
        ])
    elif isinstance(dtype, T.MapType):
        pairs = F.map_entries(F.transform_values(response, lambda _k, v: v.cast("string")))
    else:
        pairs = F.array().cast("array<struct<key: string, value: string>>")
    rest = [c for c in df.columns if c not in (response, prompt)]
    exploded = df.filter(F.col(response).isNotNull()).select(*rest, F.explode(pairs).alias("_e"))
    return exploded.select(*rest, F.lit("").alias(prompt), F.col("_e.key").alias("field"), F.col("_e.value").alias(response))


def explode_concepts(df: DataFrame, concepts: str = "concepts_list", name: str = "concept") -> DataFrame:
    """``"[a, b ,]"`` becomes one row per non-empty entry."""
    parts = F.transform(F.split(F.translate(F.col(concepts), "[]", ""), ","), lambda x: F.trim(x))
    # Dropping empty entries after the explosion lets the planner split each text once.
    return df.withColumn(name, F.explode_outer(parts)).filter(F.col(name) != "")


def collect_questions(questions: Sequence[str]) -> Column:
    """Array of ``{question}`` from separate columns, skipping null and empty ones."""
    return F.filter(
        F.array(*[F.struct(F.col(q).alias("question")) for q in questions]),
        lambda x: F.coalesce(x["question"] != "", F.lit(False)),
    )


def explode_questions(df: DataFrame, questions: Sequence[str], key: str) -> DataFrame:
    """One row per question, with the generator's ``key`` and the 1-based position among those kept."""
    rest = [c for c in df.columns if c not in questions]
    out = df.select(*rest, F.posexplode(collect_questions(questions)).alias("_p", "_q"))
    return out.select(*rest, F.lit(key).alias("kind"), (F.col("_p") + 1).alias("question_no"), F.col("_q.question"))


def unpivot_examples(df: DataFrame, ids: Sequence[str], prefix: str = "example_", count: int = 5) -> DataFrame:
    """``example_1`` … ``example_n`` become rows (example_no, example); empty ones are dropped."""
    values = F.array(*[F.col(f"{prefix}{i}") for i in range(1, count + 1)])
    rows = df.select(*ids, F.posexplode(values).alias("_p", "example"))
    return rows.filter(F.coalesce(F.col("example") != "", F.lit(False))).select(
        *ids, (F.col("_p") + 1).alias("example_no"), "example"
    )


def zip_shortest(df: DataFrame, left: str, right: str, ids: Sequence[str]) -> DataFrame:
    """Pair two arrays element by element up to the shorter one."""
    n = F.least(F.size(left), F.size(right))
    pairs = F.arrays_zip(F.slice(left, F.lit(1), n).alias(left), F.slice(right, F.lit(1), n).alias(right))
    rows = df.select(*ids, F.posexplode(pairs).alias("pair_no", "_z"))
    return rows.select(*ids, "pair_no", F.col("_z").getField(left).alias(left), F.col("_z").getField(right).alias(right))


def _glossary_lines(text: Column) -> Column:
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: x != "")


def parse_glossary(text: Column) -> Column:
    """Entries of a generated glossary: JSON, fenced or not, as a list or under the key ``glossary``."""
    body = strip_fence(text)
    listed = F.from_json(body, GLOSSARY)
    wrapped = F.from_json(body, f"struct<glossary: {GLOSSARY}>").getField("glossary")
    return F.when(body.startswith("["), listed).otherwise(wrapped)


def parse_existing_glossary(text: Column) -> Column:
    """Entries of a stored glossary: a JSON array, or JSON lines of which unreadable ones are skipped."""
    body = F.trim(text)
    by_line = F.transform(_glossary_lines(body), lambda x: F.from_json(x, "struct<input: string, output: string>"))
    readable = F.filter(by_line, lambda e: e["input"].isNotNull() | e["output"].isNotNull())
    return F.when(body.startswith("["), F.from_json(body, GLOSSARY)).otherwise(readable)


def merge_glossary(df: DataFrame, ids: Sequence[str], generated: str = "response",
                   existing: str = "input_glossary") -> DataFrame:
    """``glossary_entries`` as rows (ids, origin, entry_no, input, output)."""
    return df.select(*ids, F.inline(glossary_entries(F.col(generated), F.col(existing))))


def glossary_entries(generated: Column, existing: Column) -> Column:
    """Existing entries followed by the generated ones, as an array of (origin, entry_no, input, output).

    A generated entry with line breaks is split and paired line by line; others are trimmed.
    """

    def pairs(e):
        ins, outs = _glossary_lines(e["input"]), _glossary_lines(e["output"])
        n = F.least(F.size(ins), F.size(outs))
        many = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(F.get(ins, i).alias("input"), F.get(outs, i).alias("output")),
        )
        one = F.array(F.struct(
            F.trim(F.coalesce(e["input"], F.lit(""))).alias("input"),
            F.trim(F.coalesce(e["output"], F.lit(""))).alias("output"),
        ))
        broken = F.coalesce(e["input"], F.lit("")).contains("\n") | F.coalesce(e["output"], F.lit("")).contains("\n")
        return F.when(~broken, one).when(n > 0, many).otherwise(F.array().cast(GLOSSARY))

    new = F.flatten(F.transform(parse_glossary(generated), pairs))
    parts = [("existing", parse_existing_glossary(existing)), ("generated", new)]
    # One pass over the input: both parts of a row sit in one array before it is exploded.
    def tagged_as(origin, entries):
        rows = F.transform(entries, lambda e, i: F.struct(
            F.lit(origin).alias("origin"), i.alias("entry_no"), e["input"].alias("input"), e["output"].alias("output")))
        return F.coalesce(rows, F.array().cast("array<struct<origin: string, entry_no: int, input: string, output: string>>"))

    return F.concat(*[tagged_as(origin, entries) for origin, entries in parts])


def record_text(df: DataFrame, keys: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Retrieval text of a record: ``Key: value`` lines of its ``_input``/``_output`` structs, or of ``keys``
    (step column → field names; fields a step lacks are skipped)."""
    if keys is None:
        keys = {
            f.name: f.dataType.names for f in df.schema
            if f.name.endswith(("_input", "_output")) and isinstance(f.dataType, T.StructType)
        }
    parts = []
    for step, fields in keys.items():
        have = df.schema[step].dataType.names
        for field in fields:
            if field in have:
                value = F.coalesce(F.col(step).getField(field).cast("string"), F.lit("None"))
                parts.append(F.concat(F.lit(f"{field.title()}: "), value, F.lit("\n")))
    return F.concat(*parts) if parts else F.lit("")


def failed_variations(df: DataFrame, arrays: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Failed entries of nested variation arrays: (question, generated_sql, error_message, error_explanation).

    Each entry is judged by ``validation``, or by ``final_validation`` when it has none.
    """
    def tagged(name):
        rows = F.transform(F.col(name), lambda v: F.struct(F.lit(name).alias("origin"), v.alias("v")))
        return F.coalesce(rows, F.array().cast(_entry_type(df, name)))

    entries = F.concat(*[tagged(a) for a in arrays])
    rows = df.select(*ids, F.explode(entries).alias("_e")).select(*ids, "_e.origin", F.col("_e.v").alias("_v"))
    verdict = F.coalesce(F.col("_v.validation"), F.col("_v.final_validation"))
    return rows.withColumn("_j", verdict).filter(~F.coalesce(F.col("_j.is_valid"), F.lit(True))).select(
        *ids,
        "origin",
        F.coalesce(F.col("_v.question"), F.col("_v.sub_question"), F.lit("")).alias("question"),
        F.coalesce(F.col("_v.generated_sql"), F.col("_v.original_sql"), F.lit("")).alias("generated_sql"),
        F.coalesce(F.col("_j.error"), F.lit("")).alias("error_message"),
        F.coalesce(F.col("_j.explanation"), F.lit("")).alias("error_explanation"),
    )


def _entry_type(df: DataFrame, name: str) -> T.ArrayType:
    element = df.schema[name].dataType.elementType
    return T.ArrayType(T.StructType([T.StructField("origin", T.StringType(), False), T.StructField("v", element)]))
