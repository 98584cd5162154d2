"""Sources and sinks: each query writes to the shared scratch folder and reads back what it wrote."""

from pyspark.sql import functions as F

from promptloom.functions.templates import CHAT_TEMPLATES, MISTRAL_SYSTEM_PROMPT
from promptloom.operators import retrieval as ret
from promptloom.registry.aggregates import product_answers
from promptloom.registry.base import embedded_sql, prompts, q, query
from promptloom.sources import datasets, pairs
from promptloom.storage import scratch_path
from promptloom.testing.doubles import letter_encoder

_CLEAN = "regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')"


@query("training_pairs", f"""
SELECT doc_id, replace(replace({q(CHAT_TEMPLATES["mistral"])}, '{{system}}', {q(MISTRAL_SYSTEM_PROMPT)}), '{{user}}', text) AS input,
       coalesce(nullif(lang, 'en'), '') AS output FROM documents""")
def training_pairs(t):
    rows = t.documents.select("doc_id", F.col("text").alias("user"), F.nullif(F.col("lang"), F.lit("en")).alias("lang"))
    made = pairs.pairs_from(rows, "user", "lang", CHAT_TEMPLATES["mistral"], system=F.lit(MISTRAL_SYSTEM_PROMPT))
    return made.select("doc_id", "input", "output")


@query("bounded_examples", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 50")
def bounded_examples(t):
    """The limit is the feature: the first examples of a data set."""
    return pairs.bounded(t.documents.select("doc_id", "text"), "doc_id", 50)


@query("training_subset", "SELECT doc_id, text AS input, lang AS output FROM documents ORDER BY doc_id LIMIT 500")
def training_subset(t):
    """The limit is the feature: a training run takes at most 500 pairs."""
    return pairs.training_subset(pairs.pairs_from(t.documents, "text", "lang").select("doc_id", "input", "output"), "doc_id")


@query("load_pairs_jsonl", "SELECT text AS input, coalesce(nullif(lang, 'en'), '') AS output FROM documents")
def load_pairs_jsonl(t):
    path = scratch_path(t.spark, "pairs") + ".jsonl"
    t.documents.select(F.col("text").alias("question"), F.nullif(F.col("lang"), F.lit("en")).alias("answer"), "n_chars").write.json(path)
    return pairs.load_pairs(t.spark, path, "question", "answer")


@query("load_pairs_csv", "SELECT p_name AS input, coalesce(nullif(p_brand, 'Brand#1'), '') AS output FROM part")
def load_pairs_csv(t):
    path = scratch_path(t.spark, "pairs") + ".csv"
    t.part.select(F.col("p_name").alias("input"), F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("output")).write.csv(path, header=True)
    return pairs.load_pairs(t.spark, path)


@query("load_pairs_csv_lines", """
SELECT coalesce(replace(text, ' ', chr(10)), '') AS input, '"' || lang || '", ' || source AS output FROM documents""")
def load_pairs_csv_lines(t):
    """Every text with a line break behind each word, quotes and commas in the other column."""
    path = scratch_path(t.spark, "pairs") + ".csv"
    broken = F.translate("text", " ", "\n")
    t.documents.select(
        broken.alias("input"), F.format_string('"%s", %s', "lang", "source").alias("output")).write.csv(
        path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return pairs.load_pairs(t.spark, path)


@query("write_dataset", "SELECT event_id, event_type, props, (SELECT count(*) FROM events) AS n_written FROM events")
def write_dataset(t):
    """The second write finds the data set and leaves it alone."""
    folder = scratch_path(t.spark, "datasets")
    rows = t.events.select("event_id", "event_type", "props")
    written = datasets.write_dataset(rows, folder, "events")
    datasets.write_dataset(rows.filter("event_type = 'error'"), folder, "events")
    back = datasets.read_dataset(t.spark, folder, "events", "event_id long, event_type string, props string")
    return back.withColumn("n_written", F.lit(written).cast("long"))


@query("append_rows", "SELECT doc_id, text, lang AS dataset_name FROM documents")
def append_rows(t):
    path = scratch_path(t.spark, "store")
    for lang in ("en", "de", "fr", "es"):
        datasets.append_rows(t.documents.filter(F.col("lang") == lang).select("doc_id", "text"), path, lang)
    return t.spark.read.schema("doc_id long, text string, dataset_name string").json(path)


@query("class_example_store", "SELECT lang AS class_name, text AS example FROM documents")
def class_example_store(t):
    path = scratch_path(t.spark, "classes")
    datasets.save_class_examples(datasets.class_example_lines(t.documents, "lang", "text", "doc_id", 100), path)
    return datasets.load_class_examples(t.spark, path)


@query("index_round_trip", f"""
WITH e AS ({embedded_sql("benchmark", "item_id", "text")})
SELECT text AS split, CAST(i - 1 AS INT) AS dim, round(CAST(e[i] AS DOUBLE), 6) AS value FROM (SELECT text, e, unnest(range(1, 27)) AS i FROM e)""")
def index_round_trip(t):
    path = scratch_path(t.spark, "index")
    ret.save_index(ret.index_rows(t.benchmark, "text", letter_encoder, ["item_id"]), path)
    rows = ret.load_index(t.spark, path).select("split", F.posexplode("embedding").alias("dim", "v"))
    return rows.select("split", "dim", F.round(F.col("v").cast("double"), 6).alias("value"))


def _stepped(t):
    return prompts(t).select(
        "prompt_id", "prompt", F.struct("lang").alias("review_input"), F.struct(F.col("prompt").alias("echo")).alias("review_output"),
        F.struct("source").alias("other_output"), F.col("source").alias("response"),
    )


@query("step_record", f"""
SELECT {_CLEAN} AS prompt, source AS response, lang AS in_lang, {_CLEAN} AS out_echo FROM documents""")
def step_record(t):
    """The full records of a step, written as JSON lines and read back."""
    folder = scratch_path(t.spark, "records")
    rows = _stepped(t)
    datasets.record_step(rows, folder, "review")
    back = t.spark.read.schema(rows.drop("prompt_id").schema).json(f"{folder}/review_full")
    return back.select("prompt", "response", F.col("review_input.lang").alias("in_lang"), F.col("review_output.echo").alias("out_echo"))


@query("step_record_io", f"SELECT lang AS in_lang, {_CLEAN} AS out_echo, source AS other FROM documents")
def step_record_io(t):
    """Final records: every input and output column, and nothing else."""
    io = datasets.step_records(_stepped(t), None)["data_io"]
    assert io.columns == ["review_input", "review_output", "other_output"]
    return io.select(F.col("review_input.lang").alias("in_lang"), F.col("review_output.echo").alias("out_echo"), F.col("other_output.source").alias("other"))


@query("save_step", f"SELECT doc_id AS prompt_id, {_CLEAN} AS prompt FROM documents")
def save_step(t):
    path = scratch_path(t.spark, "saved")
    datasets.save_records(prompts(t), path, ["prompt_id", "prompt"])
    return t.spark.read.schema("prompt_id long, prompt string").json(path)


@query("answer_log", """
SELECT 'Find ' || p_name AS prompt, p_brand AS answer, p_partkey % 10 <> 0 AS is_exact_match FROM part""")
def answer_log(t):
    answers = product_answers(t).join(t.part, F.col("id") == F.col("p_partkey")).select(
        F.concat(F.lit("Find "), F.col("p_name")).alias("prompt"), F.col("p_brand").alias("response"), "is_exact_match"
    )
    path = datasets.save_answers(answers, scratch_path(t.spark, "answers"), "double", "products", "run1")
    return t.spark.read.schema("prompt string, answer string, is_exact_match boolean").json(path)


