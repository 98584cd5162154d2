"""Streaming jobs, run to the end of the given table."""

from pyspark.sql import functions as F

from promptloom.operators import retrieval as ret
from promptloom.registry.base import embedded_sql, query
from promptloom.registry.retrieval import ALL_DIMENSIONS, all_dimensions
from promptloom.storage import scratch_path
from promptloom.streaming import jobs
from promptloom.testing.doubles import letter_encoder, refusing_model


def stream(t, name):
    # A stream source takes a folder or a pattern; this pattern matches the table be it a file or a folder.
    return jobs.read_files(t.spark, f"{t.folder}/{name}.parque[t]", getattr(t, name).schema)


@query("stream_generate", """
SELECT doc_id, 'failed' AS outcome, NULL AS response, 3 AS attempts FROM documents WHERE contains(text, 'and')
UNION ALL SELECT doc_id, 'answered', length(text) || ':' || text, 1 FROM documents WHERE NOT contains(text, 'and')""")
def stream_generate(t):
    """A stream over the documents, then what its ledger holds: only requests that failed three times are dead letters."""
    base = scratch_path(t.spark, "stream")
    model, paths = refusing_model("and"), (f"{base}/answered", f"{base}/failed")
    prompts = stream(t, "documents").select("doc_id", F.col("text").alias("prompt"))
    jobs.stream_generate(prompts, model, *paths, f"{base}/checkpoint", batch_size=1).awaitTermination()
    jobs.finish_retries(t.spark, model, *paths, batch_size=1)
    parts = [t.spark.read.parquet(f"{base}/{o}").select("doc_id", F.lit(o).alias("outcome"), "response", "attempts") for o in ("answered", "failed")]
    return parts[0].unionByName(parts[1])


@query("stream_index_append", f"""
WITH e AS ({embedded_sql("documents", "doc_id", "text")}) SELECT text AS split, {ALL_DIMENSIONS} FROM e""")
def stream_index_append(t):
    """English documents by a stream, all documents in a batch, then all again by another stream: each is in the index once."""
    base = scratch_path(t.spark, "stream")
    english = stream(t, "documents").filter("lang = 'en'")
    jobs.stream_index(english, letter_encoder, f"{base}/index", f"{base}/first").awaitTermination()
    ret.append_to_index(t.documents, f"{base}/index", "text", letter_encoder, ["doc_id"])
    jobs.stream_index(stream(t, "documents"), letter_encoder, f"{base}/index", f"{base}/second").awaitTermination()
    return all_dimensions(ret.load_index(t.spark, f"{base}/index"))


@query("stream_records", "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS text FROM documents")
def stream_records(t):
    base = scratch_path(t.spark, "stream")
    jobs.stream_records(stream(t, "documents"), f"{base}/out", f"{base}/checkpoint", ["doc_id", "text"]).awaitTermination()
    return t.spark.read.schema("doc_id long, text string").json(f"{base}/out")


@query("stream_progress", """
SELECT conv_id AS request_id, count(*) AS n_items, count(f) AS n_available, count(*) = count(f) AS done,
  conv_id * 60 + max(turn) + 600 < (SELECT max(conv_id * 60 + turn) FROM conversations) - 60 AS closed FROM (
  SELECT *, CASE WHEN text LIKE '%.' THEN 'stop' END AS f FROM conversations) GROUP BY conv_id""")
def stream_progress(t):
    """A conversation starts every minute; it is closed once ten minutes have passed without a turn."""
    base = scratch_path(t.spark, "stream")
    items = stream(t, "conversations").select(
        F.col("conv_id").alias("request_id"), F.when(F.col("text").endswith("."), "stop").alias("finish_reason"),
        F.timestamp_seconds(F.col("conv_id") * 60 + F.col("turn")).alias("at"),
    )
    jobs.stream_progress(items, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return jobs.latest_progress(t.spark, f"{base}/out")
