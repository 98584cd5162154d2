"""Named JSON-lines data sets, class examples, step records and answer logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from promptloom.functions.text import ascii_clean_columns
from promptloom.operators.positions import assign_batches
from promptloom.operators.records import select_keys
from promptloom.storage import path_exists

EXAMPLES_PER_LINE = 100


def write_dataset(df: DataFrame, folder: str, name: str) -> int | None:
    """Write ``folder/name`` once and return the number of rows, counted in the same pass.

    A data set that was written to the end is left as it is and None is returned; what a failed write left is replaced.
    """
    path = f"{folder}/{name}"
    if path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        return None
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def read_dataset(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """Pass a schema where it is known: inferring one reads the whole data set first."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(f"{folder}/{name}")


def append_rows(df: DataFrame, path: str, dataset_name: str) -> None:
    """Add rows to a named part of a store, kept as a partition folder."""
    df.withColumn("dataset_name", F.lit(dataset_name)).write.mode("append").partitionBy("dataset_name").json(path)


def class_example_lines(df: DataFrame, class_name: str, example: str, order_by: str,
                        per_line: int = EXAMPLES_PER_LINE, **options) -> DataFrame:
    """(class_name, line_no, examples): the examples of a class in order, as lines of bounded length, so that
    a class of any size is written by many tasks."""
    rows = df.select(F.col(class_name).alias("class_name"), F.col(example).alias("_x"), F.col(order_by).alias("_o"))
    batched = assign_batches(rows, per_line, ["_o"], ["class_name"], "line_no", **options)
    listed = F.array_sort(F.collect_list(F.struct("_o", "_x")))
    return batched.groupBy("class_name", "line_no").agg(F.transform(listed, lambda e: e["_x"]).alias("examples"))


def save_class_examples(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select("class_name", "examples").write.mode(mode).json(path)


def load_class_examples(spark: SparkSession, path: str) -> DataFrame:
    """One row per example: (class_name, example)."""
    lines = spark.read.schema("class_name string, examples array<string>").json(path)
    return lines.select("class_name", F.explode("examples").alias("example"))


def step_records(df: DataFrame, step: str | None) -> dict[str, DataFrame]:
    """ASCII-clean projections of a step: ``full``, ``prompt_response`` and ``data_io``.

    Without a step name these are the final records: every ``_input`` and ``_output`` column.
    """
    if step is None:
        wanted = [c for c in df.columns if c.endswith(("_input", "_output"))]
        return {"data_io": ascii_clean_columns(df.select(*wanted))}
    present = df.filter(F.col("prompt").isNotNull())
    io = [c for c in (f"{step}_input", f"{step}_output") if c in df.columns]
    return {
        "full": ascii_clean_columns(present),
        "prompt_response": ascii_clean_columns(present.select("prompt", "response")),
        "data_io": ascii_clean_columns(present.select(*io)),
    }


def record_step(df: DataFrame, folder: str, step: str | None) -> None:
    """Append the records of a step as JSON lines. Pass a stored DataFrame: it is read once per record kind."""
    for kind, rows in step_records(df, step).items():
        rows.write.mode("append").json(f"{folder}/{step}_{kind}" if step else f"{folder}/{kind}")


def save_records(df: DataFrame, path: str | None, keys: Sequence[str] | None = None) -> DataFrame:
    """ASCII-clean chosen columns, appended to ``path`` when one is given."""
    rows = ascii_clean_columns(select_keys(df, keys))
    if path is not None:
        rows.write.mode("append").json(path)
    return rows


def answer_log(df: DataFrame) -> DataFrame:
    """(prompt, question, answer, is_exact_match); ``question`` is left out where there is none."""
    names = ["prompt", *(["question"] if "question" in df.columns else [])]
    return df.select(*names, F.col("response").alias("answer"), "is_exact_match")


def save_answers(df: DataFrame, folder: str, model_name: str, task: str, stamp: str) -> str:
    """Write the answer log of a run and return its path."""
    path = f"{folder}/{model_name}/custom-{task}-{stamp}"
    answer_log(df).write.json(path)
    return path
