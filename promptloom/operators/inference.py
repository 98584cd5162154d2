"""Model calls as a column: the model sees Arrow batches of prompts, everything else stays in the JVM."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.functions.schema import response_schema
from promptloom.storage import materialise, path_exists

# A model is opened once per task: a picklable factory that returns a function from prompts to responses.
# A response of None means the model gave none; raising fails the batch.
Predict = Callable[[pd.Series], pd.Series]
Model = Callable[[], Predict]

BATCH_SIZE = 5
RETRY_LIMIT = 3

_RESULT = T.StructType([
    T.StructField("response", T.StringType()),
    T.StructField("error", T.ArrayType(T.StringType())),
    T.StructField("attempts", T.IntegerType()),
])


# Characters a call of an encoder gets, the longest text's times the number of texts.
ENCODER_BUDGET = 1 << 20


def _lengths(texts: pd.Series) -> list[int]:
    return [0 if pd.isna(x) else len(x) for x in texts]


def _attempt(predict: Predict, prompts: pd.Series, retry_limit: int) -> tuple[list, list[str], int]:
    """Call the model for one batch, at most ``retry_limit`` times in all: (responses, errors, attempts)."""
    errors: list[str] = []
    while len(errors) < retry_limit:
        try:
            answers = list(predict(prompts))
            if len(answers) != len(prompts):
                raise ValueError(f"model returned {len(answers)} responses for {len(prompts)} prompts")
            return answers, errors, len(errors) + 1
        except Exception as failure:  # a model may raise anything
            errors.append(f"{type(failure).__name__}: {failure}")
    return [None] * len(prompts), errors, len(errors)


def fixed_batches(rows: Sequence[int], size: int) -> list[list[int]]:
    return [list(rows[at : at + size]) for at in range(0, len(rows), size)]


def budget_batches(rows: Sequence[int], lengths: Sequence[int], budget: int, size: int | None = None) -> list[list[int]]:
    """Batches whose number of texts times longest length stays within ``budget``, and number within ``size``. Texts of like length come together,
    so little is padded; one that is longer than the budget comes alone."""
    out: list[list[int]] = []
    for i in sorted(rows, key=lambda i: (lengths[i], i)):
        # Lengths rise, so the newest text is the longest of its batch.
        if not out or (len(out[-1]) + 1) * lengths[i] > budget or len(out[-1]) == size:
            out.append([])
        out[-1].append(i)
    return out


def model_column(prompt: Column, model: Model, batch_size: int = BATCH_SIZE,
                 retry_limit: int = RETRY_LIMIT, budget: int | None = None) -> Column:
    """Struct of response, errors and attempts. Marked nondeterministic, so no plan evaluates it twice."""

    @F.pandas_udf(_RESULT)
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = model()
        for batch in batches:
            # Null prompts never reach the model: no response, no error, no attempt.
            responses, error, attempts = [None] * len(batch), [[] for _ in range(len(batch))], [0] * len(batch)
            known = [i for i, given in enumerate(batch.notna()) if given]
            batches_of = budget_batches(known, _lengths(batch), budget, batch_size) if budget else fixed_batches(known, batch_size)
            for rows in batches_of:
                whole = not budget and rows[-1] - rows[0] == len(rows) - 1  # no nulls between: a slice, which is quicker than a selection
                answers, errors, tries = _attempt(predict, batch.iloc[rows[0] : rows[-1] + 1] if whole else batch.iloc[rows], retry_limit)
                for i, answer in zip(rows, answers):
                    responses[i], error[i], attempts[i] = answer, errors, tries
            yield pd.DataFrame({"response": responses, "error": error, "attempts": attempts})

    return call.asNondeterministic()(prompt)


def generate(df: DataFrame, model: Model, prompt: str = "prompt", output_type: Mapping | None = None,
             batch_size: int = BATCH_SIZE, retry_limit: int = RETRY_LIMIT,
             parallelism: int | None = None, budget: int | None = None) -> DataFrame:
    """Add ``response``, ``error`` and ``attempts``; with ``output_type`` the response is a parsed struct.

    Lazy. ``parallelism`` bounds how many tasks, and so model clients, run at once. With a ``budget``, batches are made of prompts of like length and
    end where their number times the longest one's characters would pass it (see ``budget_batches``); ``batch_size`` still bounds them. Apply
    ``materialise`` before using the result more than once.
    """
    if parallelism:
        df = df.repartition(parallelism)
    called = df.withColumn("_call", model_column(F.col(prompt), model, batch_size, retry_limit, budget))
    called = called.withColumns({name: F.col("_call").getField(name) for name in _RESULT.names}).drop("_call")
    return parse_response(called, output_type) if output_type else called


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows over tasks of like size, by keys or else in turn. Short rows come from few files, or a single row group, and would stay in one task."""
    return df.hint("rebalance", *keys)


def parse_response(df: DataFrame, output_type: Mapping, response: str = "response") -> DataFrame:
    """Parse JSON text into a struct and set ``parse_ok``; text that does not parse gives null fields."""
    parsed = F.from_json(F.col(response), response_schema(output_type), {"mode": "PERMISSIVE"})
    known = F.coalesce(*[F.col("_parsed").getField(n).cast("string") for n in output_type])
    return (
        # The outer form keeps filters on fields above the parser, so that a text is parsed once.
        df.select("*", F.explode_outer(F.array(parsed)).alias("_parsed"))
        .withColumns({response: F.col("_parsed"), "parse_ok": known.isNotNull()})
        .drop("_parsed")
    )


def is_dead(response: str = "response", error: str = "error") -> Column:
    return F.col(response).isNull() & (F.size(F.coalesce(F.col(error), F.array().cast("array<string>"))) > 0)


def split_failed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answered, failed) of a model output, which is stored first so that no call is repeated."""
    stored = materialise(df, "responses")
    return stored.filter(~is_dead()), stored.filter(is_dead())


def request_key(model_name: str, prompt: Column, output_type: Mapping | None = None) -> Column:
    """Identity of a request: a digest of the prompt behind a digest, of fixed length, of everything else."""
    rest = repr((model_name, sorted((k, str(v)) for k, v in (output_type or {}).items())))
    return F.sha2(F.concat(F.lit(hashlib.sha256(rest.encode()).hexdigest()), prompt), 256)


def cached_generate(df: DataFrame, model: Model, model_name: str, cache_path: str, prompt: str = "prompt",
                    output_type: Mapping | None = None, **options) -> DataFrame:
    """``generate`` through a Parquet cache; adds ``cache_hit``, and ``error`` and ``attempts`` as there (no attempt for a hit).

    The cache keeps its answers in folders by the first digit of their keys; only folders that a request may be in are read. Only keys the cache
    lacks reach the model, each once however many rows share it. Answered ones are
    appended to the cache; failed ones and null prompts are not, and stay null in the result. Runs the model on call.
    """
    spark = df.sparkSession
    keyed = df.withColumn("request_key", request_key(model_name, F.col(prompt), output_type))
    asked = keyed.filter(F.col(prompt).isNotNull())
    prefixes = [r[0] for r in asked.select(_prefix()).distinct().collect()]  # at most 16
    # One shuffle brings the rows of a key and its cached answer together and tells hits from misses; a prompt that many rows share is cut
    # to one row before it. Prompts of one key are equal. Stored, so a hit never includes this run's own answers.
    requests = asked.select("request_key", F.col(prompt).alias("prompt"), F.lit(None).cast("string").alias("response"))
    both = requests.unionByName(read_cache(spark, cache_path, prefixes, once=False).withColumn("prompt", F.lit(None).cast("string")))
    met = both.groupBy("request_key").agg(F.max("prompt").alias("prompt"), F.min("response").alias("response")).filter("prompt is not null")
    looked_up = materialise(met.withColumn("prompt", F.when(F.col("response").isNull(), F.col("prompt"))), "lookups")
    hits, wanted = looked_up.filter("response is not null"), looked_up.filter("response is null")
    fresh = materialise(generate(wanted.drop("response"), model, "prompt", **options).select("request_key", *_RESULT.names), "fresh")
    answered = fresh.filter(F.col("response").isNotNull()).select("request_key", "response", _prefix().alias("prefix"))
    answered.hint("rebalance", "prefix").write.mode("append").partitionBy("prefix").parquet(cache_path)
    none = {"error": F.array().cast("array<string>"), "attempts": F.lit(0), "cache_hit": F.lit(True)}
    known = hits.drop("prompt").withColumns(none).unionByName(fresh.withColumn("cache_hit", F.lit(False)))
    # Unique on the right; adaptive execution splits the left side of a key that dominates.
    joined = keyed.join(known, "request_key", "left")
    return parse_response(joined, output_type) if output_type else joined


def _prefix() -> Column:
    return F.substring("request_key", 1, 1)


def read_cache(spark: SparkSession, cache_path: str, prefixes: Sequence[str] | None = None, once: bool = True) -> DataFrame:
    """(request_key, response) of a cache, each key once, or with ``once`` off as stored; of the folders of some prefixes, or all."""
    schema = "request_key string, response string"
    if not path_exists(spark, cache_path):
        return spark.createDataFrame([], schema)
    cached = spark.read.schema(f"{schema}, prefix string").parquet(cache_path)
    if prefixes is not None:
        cached = cached.filter(F.col("prefix").isin(list(prefixes)))
    if not once:
        return cached.select("request_key", "response")
    return cached.groupBy("request_key").agg(F.min("response").alias("response"))


def compact_cache(spark: SparkSession, cache_path: str) -> None:
    """Rewrite a cache, which gains files with every run, with each key once and about one file a folder. Nothing may read or append meanwhile."""
    whole = materialise(read_cache(spark, cache_path).withColumn("prefix", _prefix()), "cache")
    whole.hint("rebalance", "prefix").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("prefix").parquet(cache_path)


def embed(df: DataFrame, encoder: Callable, text: str = "text", name: str = "embedding", budget: int = ENCODER_BUDGET) -> DataFrame:
    """Add an embedding. ``encoder`` is a factory like a model, from texts to equal-length float lists.

    Null text has a null embedding and never reaches the encoder, which gets texts of like length, as many as ``budget`` allows. The others of a batch stay in
    Arrow's memory meanwhile, so what a task holds as Python objects follows the budget, not the batch.
    """

    @F.arrow_udf("array<float>")
    def call(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder()
        for batch in batches:
            out = [None] * len(batch)
            known = [i for i, given in enumerate(batch.is_valid().to_pylist()) if given]
            for rows in budget_batches(known, pc.utf8_length(batch).to_pylist(), budget):
                vectors = list(encode(batch.take(pa.array(rows)).to_pandas().set_axis(rows)))
                if len(vectors) != len(rows):
                    raise ValueError(f"encoder returned {len(vectors)} embeddings for {len(rows)} texts")
                for i, vector in zip(rows, vectors):
                    out[i] = vector
            yield pa.Array.from_pandas(pd.Series(out, dtype=object), type=pa.list_(pa.float32()), safe=False)

    return df.withColumn(name, call.asNondeterministic()(F.col(text).cast("string")))


def request_progress(items: DataFrame, request: str = "request_id", finish: str = "finish_reason") -> DataFrame:
    """Items of each request, how many have finished, and whether all have. Also valid on a stream."""
    counted = items.groupBy(request).agg(F.count("*").alias("n_items"), F.count(finish).alias("n_available"))
    return counted.withColumn("done", F.col("n_items") == F.col("n_available"))
