"""Record-level steps: lineage, snapshots, merging, hooks and filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.functions.templates import require_columns

Hook = Callable[[DataFrame], DataFrame]


def keep_origin(df: DataFrame, prompt: str = "prompt", data: Sequence[str] = ()) -> DataFrame:
    """Remember the first prompt and data of a record; a record that has them keeps them."""
    if "orig_prompt" not in df.columns:
        df = df.withColumn("orig_prompt", F.col(prompt))
    if "orig_data" not in df.columns and data:
        df = df.withColumn("orig_data", F.struct(*data))
    return df


def snapshot_input(df: DataFrame, step: str, keys: Sequence[str]) -> DataFrame:
    """``<step>_input``: the values the template of the step reads."""
    require_columns(df, keys, step)
    return df.withColumn(f"{step}_input", F.struct(*keys))


def merge_response(df: DataFrame, step: str, response: str = "response") -> DataFrame:
    """``<step>_output`` plus one column per response field; a field replaces a column of its name."""
    dtype = df.schema[response].dataType
    df = df.withColumn(f"{step}_output", F.col(response))
    if not isinstance(dtype, T.StructType):
        return df
    return df.withColumns({f.name: F.col(f"{step}_output").getField(f.name) for f in dtype})


def rename_expected(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Gold values become ``expected_<name>`` so that a model cannot be shown them by accident."""
    require_columns(df, names, "expected values")
    return df.withColumnsRenamed({n: f"expected_{n}" for n in names})


def lift_field(df: DataFrame, struct: str, field: str, name: str) -> DataFrame:
    """Move a field out of a struct column."""
    return df.withColumns({name: F.col(struct).getField(field), struct: F.col(struct).dropFields(field)})


def modify_rows(df: DataFrame, change: Hook, required: Sequence[str] = ("response",)) -> DataFrame:
    """Drop records whose required values are null, then apply ``change``."""
    return df.dropna(how="any", subset=list(required)).transform(change)


def run_hooks(df: DataFrame, before: Hook | None, step: Hook, after: Hook | None) -> DataFrame:
    """A step between two hooks; each may drop records or fan them out."""
    for hook in (before, step, after):
        if hook is not None:
            df = df.transform(hook)
    return df


def rename_keys(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    require_columns(df, mapping, "renaming")
    return df.withColumnsRenamed(dict(mapping))


def select_keys(df: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    """Keep ``keys``, or every column when none are given."""
    if not keys:
        return df
    require_columns(df, keys, "selection")
    return df.select(*keys)
