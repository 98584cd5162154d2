"""Registration of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptloom.sources.tables import parquet_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return parquet_table(self.spark, self.folder, name)


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables)`` under ``name``."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        QUERIES[name].__doc__ = fn.__doc__
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def q(text: str) -> str:
    """SQL literal of a text."""
    return "'" + text.replace("'", "''") + "'"


def prompts(t: Tables) -> DataFrame:
    """Documents as prompt records."""
    return t.documents.select(F.col("doc_id").alias("prompt_id"), F.col("text").alias("prompt"), "lang", "source", "n_chars")


def text(value: str) -> Column:
    return F.lit(value).cast("string")


# Letter-count embedding of a text column in SQL, as the test double computes it.
def letter_embedding_sql(column: str) -> str:
    counts = ", ".join(f"length({column}_l) - length(replace({column}_l, '{c}', ''))" for c in "abcdefghijklmnopqrstuvwxyz")
    return f"[{counts}]"


def embedded_sql(table: str, key: str, column: str) -> str:
    """CTE body: (key, text, e) with e the unit-length letter counts as floats."""
    return (
        f"SELECT {key}, {column}, [CAST(CASE WHEN n = 0 THEN 0.0 ELSE x / sqrt(n) END AS FLOAT) FOR x IN c] AS e FROM ("
        f"SELECT *, CAST(list_sum([x * x FOR x IN c]) AS DOUBLE) AS n FROM ("
        f"SELECT {key}, {column}, {letter_embedding_sql(column)} AS c FROM ("
        f"SELECT *, lower({column}) AS {column}_l FROM {table})))"
    )


def squared_distance_sql(a: str, b: str) -> str:
    return (
        "list_sum([(CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) "
        f"FOR p IN list_zip({a}, {b})])"
    )
