"""Streams of prompts, index rows, records and request items.

Every job takes a checkpoint folder; restarting from it adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from promptloom.functions.text import ascii_clean_columns
from promptloom.operators.inference import RETRY_LIMIT, Model, generate, is_dead
from promptloom.operators.records import select_keys
from promptloom.operators.retrieval import append_to_index
from promptloom.storage import list_names, stored


# By default a job runs over what is there and ends; pass e.g. {"processingTime": "1 minute"} as ``trigger`` to keep it running.
RUN_OUT = {"availableNow": True}


def read_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    """A stream of files; ``files_per_trigger`` bounds how much one batch takes in."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def stream_generate(prompts: DataFrame, model: Model, answered_path: str, failed_path: str, checkpoint: str, prompt: str = "prompt",
                    trigger: dict | None = None, retry_limit: int = RETRY_LIMIT, wait_seconds: float = 0, **options) -> StreamingQuery:
    """Answers and dead letters of a prompt stream, in two tables; ``attempts`` and ``error`` count over all batches.

    A request is tried once a batch. One that fails goes to a ledger beside ``failed_path``, due after ``wait_seconds``, and the next batch tries it again with its
    own prompts; after ``retry_limit`` attempts in all it is a dead letter. ``finish_retries`` tries what is left in the ledger when a stream has ended.

    A batch is written once per batch number, each number a folder that it overwrites, and reads only the ledger of the batch before; so a
    batch replayed after a failure replaces its own rows and repeats no other's.
    """

    def write(batch: DataFrame, number: int) -> None:
        _try_once(batch, _waiting(batch.sparkSession, failed_path, number - 1), model, answered_path, failed_path, f"batch={number}/retry=0", prompt,
                  retry_limit, wait_seconds, options)

    return (
        prompts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or RUN_OUT)).start()
    )


def _ledger(failed_path: str) -> str:
    return f"{failed_path.rstrip('/')}-waiting"


def _waiting(spark: SparkSession, failed_path: str, number: int) -> DataFrame | None:
    """What the last attempt of a batch left in the ledger."""
    folder = f"{_ledger(failed_path)}/batch={number}"
    tries = [int(n.removeprefix("retry=")) for n in list_names(spark, folder) if n.startswith("retry=")]
    return spark.read.parquet(f"{folder}/retry={max(tries)}") if tries else None


def _try_once(batch: DataFrame | None, waiting: DataFrame | None, model: Model, answered_path: str, failed_path: str, part: str, prompt: str,
              retry_limit: int, wait_seconds: float, options: dict) -> None:
    before = {"_error": F.array().cast("array<string>"), "_attempts": F.lit(0), "_due": F.lit(None).cast("timestamp")}
    asked = batch.withColumns(before) if batch is not None else None
    if waiting is not None:
        asked = waiting if asked is None else asked.unionByName(waiting)
    asked = asked.withColumn("_now", F.coalesce(F.col("_due") <= F.current_timestamp(), F.lit(True)))
    # A request that is not due reaches the model as a null prompt, that is, not at all.
    called = generate(asked.withColumn("_asked", F.when(F.col("_now"), F.col(prompt))), model, "_asked", retry_limit=1, **options)
    called = called.withColumns({"error": F.concat("_error", "error"), "attempts": F.col("_attempts") + F.col("attempts")})
    with stored(called.drop("_asked", "_error", "_attempts"), "tried") as tried:
        again = ~F.col("_now") | (is_dead() & (F.col("attempts") < retry_limit))
        out = tried.filter(~again).drop("_now", "_due")
        due = F.when(F.col("_now"), F.current_timestamp() + F.make_dt_interval(secs=F.lit(float(wait_seconds)))).otherwise(F.col("_due"))
        left = tried.filter(again).withColumn("_due", due).drop("_now", "response", "parse_ok").withColumnsRenamed({"error": "_error", "attempts": "_attempts"})
        left.write.mode("overwrite").parquet(f"{_ledger(failed_path)}/{part}")
        for rows, path in ((out.filter(~is_dead()), answered_path), (out.filter(is_dead()), failed_path)):
            rows.write.mode("overwrite").parquet(f"{path}/{part}")


def finish_retries(spark: SparkSession, model: Model, answered_path: str, failed_path: str, prompt: str = "prompt",
                   retry_limit: int = RETRY_LIMIT, **options) -> None:
    """Try what a stream that has ended left in its ledger, due or not, until every request is answered or a dead letter. The stream
    may go on afterwards, but not meanwhile."""
    batches = [int(n.removeprefix("batch=")) for n in list_names(spark, _ledger(failed_path)) if n.startswith("batch=")]
    for _ in range(retry_limit):
        waiting = _waiting(spark, failed_path, max(batches)) if batches else None
        if waiting is None or waiting.isEmpty():
            return
        done = [int(n.removeprefix("retry=")) for n in list_names(spark, f"{_ledger(failed_path)}/batch={max(batches)}") if n.startswith("retry=")]
        waiting = waiting.withColumn("_due", F.lit(None).cast("timestamp"))
        _try_once(None, waiting, model, answered_path, failed_path, f"batch={max(batches)}/retry={max(done) + 1}", prompt, retry_limit, 0, options)


def stream_index(documents: DataFrame, encoder: Callable, path: str, checkpoint: str, text: str = "text",
                 id_cols: Sequence[str] = ("doc_id",), trigger: dict | None = None) -> StreamingQuery:
    """Append the new texts of a document stream to an index, in the layout of ``append_to_index``, so streams and batches may alternate.
    Ids decide what is new: a batch replayed after a failure and documents that come again add nothing."""

    def write(batch: DataFrame, number: int) -> None:
        append_to_index(batch, path, text, encoder, id_cols)

    return documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or RUN_OUT)).start()


def stream_records(records: DataFrame, path: str, checkpoint: str, keys: Sequence[str] | None = None,
                   trigger: dict | None = None) -> StreamingQuery:
    """Append ASCII-clean chosen columns as JSON lines."""
    rows = ascii_clean_columns(select_keys(records, keys))
    return (
        rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**(trigger or RUN_OUT)).start()
    )


_PROGRESS = "opened timestamp, n_items long, n_available long, last_at timestamp, closed boolean"


def stream_progress(items: DataFrame, path: str, checkpoint: str, request: str = "request_id", finish: str = "finish_reason", at: str = "at",
                    timeout: str = "10 minutes", delay: str = "1 minute", trigger: dict | None = None) -> StreamingQuery:
    """Latest progress of each request, one Parquet part per batch holding the requests that changed.

    ``at`` is the event time of an item. A request's state ends when the watermark, the latest event time less ``delay``, has passed its last item by ``timeout``:
    then its counts are written as closed and forgotten, so the state holds only requests that are alive. Items of a request that goes on after that
    open an episode of their own, which ``latest_progress`` adds up. Late items, those behind the watermark when they come, are dropped and counted by
    Spark (``numRowsDroppedByWatermark``). Items without a request or an event time take no part.

    Items are combined by request within each task before the shuffle, so a request with very many of them sends few rows.
    """
    kind, wait = items.schema[request].dataType, _seconds(items.sparkSession, timeout)

    def combined(batches):
        for batch in batches:
            batch = batch[batch["request"].notna() & batch["at"].notna()]
            groups = batch.assign(done=batch["finish"].notna().astype("int64")).groupby("request", sort=False)
            yield groups.agg(n_items=("at", "size"), n_available=("done", "sum"), first_at=("at", "min"), at=("at", "max")).reset_index()

    def step(key, parts, state):
        import pandas as pd

        if state.hasTimedOut:
            opened, last, n, available = state.get
            state.remove()
            yield pd.DataFrame({"request": [key[0]], "opened": [opened], "n_items": [n], "n_available": [available], "last_at": [last], "closed": [True]})
            return
        opened, last, n, available = state.get if state.exists else (None, None, 0, 0)
        for part in parts:
            n, available = n + int(part["n_items"].sum()), available + int(part["n_available"].sum())
            opened = part["first_at"].min() if opened is None else opened
            last = part["at"].max() if last is None else max(pd.Timestamp(last), part["at"].max())
        state.update((pd.Timestamp(opened).to_pydatetime(), pd.Timestamp(last).to_pydatetime(), n, available))
        # The timer cannot lie behind the watermark.
        state.setTimeoutTimestamp(max(int(pd.Timestamp(last).timestamp() * 1000) + wait * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"request": [key[0]], "opened": [opened], "n_items": [n], "n_available": [available], "last_at": [last], "closed": [False]})

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumnRenamed("request", request).withColumn("batch_no", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    name = kind.simpleString()
    narrow = items.select(F.col(request).alias("request"), F.col(finish).cast("string").alias("finish"), F.col(at).cast("timestamp").alias("at"))
    parts = narrow.mapInPandas(combined, f"request {name}, n_items long, n_available long, first_at timestamp, at timestamp").withWatermark("at", delay)
    counted = parts.groupBy("request").applyInPandasWithState(
        step, f"request {name}, {_PROGRESS}", "opened timestamp, last_at timestamp, n_items long, n_available long", "update", "EventTimeTimeout")
    return counted.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or RUN_OUT)).start()


def _seconds(spark: SparkSession, interval: str) -> int:
    return int(spark.sql(f"SELECT unix_timestamp(timestamp'2000-01-01' + interval '{interval}') - unix_timestamp(timestamp'2000-01-01')").first()[0])


def latest_progress(spark: SparkSession, path: str, request: str = "request_id") -> DataFrame:
    """The newest state of each request written by ``stream_progress``: (request, n_items, n_available, done, closed), over all its episodes."""
    state = F.struct("batch_no", "closed", "n_items", "n_available")
    newest = spark.read.parquet(path).groupBy(request, "opened").agg(F.max(state).alias("s"))
    total = newest.groupBy(request).agg(F.sum("s.n_items").alias("n_items"), F.sum("s.n_available").alias("n_available"), F.bool_and("s.closed").alias("closed"))
    return total.select(request, "n_items", "n_available", (F.col("n_items") == F.col("n_available")).alias("done"), "closed")
