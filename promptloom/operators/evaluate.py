"""Evaluation aggregates: matches, scores, summaries, topic coverage and SQL error statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.functions.sql import is_blank
from promptloom.functions.text import similarity, terminate_sql
from promptloom.operators.positions import assign_batches
from promptloom.storage import materialise

# The evaluation tasks, their metrics, and the value of an absent metric.
HARNESS_TASKS = ("mmlu", "truthfulqa")
CUSTOM_TASKS = ("earnings", "products", "icd11")
SUMMARY_METRICS = (
    ("products", "product_response_subjective_score"),
    ("products", "product_id_precision_score"),
    ("earnings", "earnings_response_subjective_score"),
    ("earnings", "earnings_precision_score"),
    ("icd11", "icd11_response_subjective_score"),
    ("icd11", "icd11_precision_score"),
)
ABSENT = -1.0
# SQL error rules in order (name, texts that must all occur in the lower-cased message),
# aggregate calls, the over-representation factor and the batch and sample sizes.
SQL_ERROR_RULES = (
    ("syntax_error", ("syntax error",)),
    ("missing_column", ("column", "does not exist")),
    ("invalid_identifier", ("invalid identifier",)),
    ("schema_error", ("schema", "does not exist")),
    ("function_error", ("function",)),
    ("group_by_error", ("group by",)),
)
AGGREGATE_CALLS = ("sum(", "avg(", "count(", "min(", "max(")
UNDER_FACTOR = 1.5
TOPICS_PER_BATCH = 3
DIGEST_QUERIES = 5


def task_names(tasks: Sequence[str]) -> list[str]:
    """Known task names of a request: ``all`` stands for every one, unknown ones are skipped."""
    known = [*HARNESS_TASKS, *CUSTOM_TASKS]
    return known if "all" in tasks else [t for t in tasks if t in known]


def all_equal(*pairs: tuple[Column, Column]) -> Column:
    """True when every pair is equal; an absent value on either side makes it false."""
    out = F.lit(True)
    for a, b in pairs:
        out = out & F.coalesce(a == b, F.lit(False))
    return out


def score_tasks(df: DataFrame, task: str = "task", score: str = "score", match: str = "is_exact_match") -> DataFrame:
    """Mean judge score and precision of each task that has rows; see ``require_rows`` for an error instead of none."""
    out = df.groupBy(task).agg(
        F.avg(score).alias("mean_score"), F.avg(F.col(match).cast("int")).alias("precision"), F.count("*").alias("n_answers")
    )
    return out


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise now when ``df`` is empty."""
    if df.isEmpty():
        raise ValueError(f"no rows to evaluate: {what}")
    return df


def summarise(scores: DataFrame) -> DataFrame:
    """Fixed list of metrics (metric, value); a metric without a score is −1."""
    spark = scores.sparkSession
    metrics = spark.createDataFrame([(i, t, m) for i, (t, m) in enumerate(SUMMARY_METRICS)], "metric_no int, task string, metric string")
    value = F.when(F.col("metric").endswith("subjective_score"), F.col("mean_score")).otherwise(F.col("precision"))
    return metrics.join(scores, "task", "left").select(
        "metric_no", "metric", F.coalesce(value, F.lit(ABSENT)).alias("value")
    )


def compare_classifiers(df: DataFrame, target: str = "target", test: str = "test_output", base: str = "base_output",
                        fuzzy: float | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """Accuracy of two predictors and their wins, losses and ties, in total or by group.

    ``fuzzy`` accepts an answer whose similarity to the target reaches the threshold.
    """
    def right(answer: str) -> Column:
        if fuzzy is None:
            hit = F.col(answer) == F.col(target)
        else:
            hit = similarity(F.col(answer).cast("string"), F.col(target).cast("string")) >= fuzzy
        return F.coalesce(hit, F.lit(False))

    marked = df.select(*groups, right(test).alias("_t"), right(base).alias("_b"))
    aggs = [
        F.count("*").alias("n"),
        F.avg(F.col("_t").cast("int")).alias("test_accuracy"),
        F.avg(F.col("_b").cast("int")).alias("base_accuracy"),
        F.count_if(F.col("_t") & ~F.col("_b")).alias("wins"),
        F.count_if(~F.col("_t") & F.col("_b")).alias("losses"),
        F.count_if(F.col("_t") == F.col("_b")).alias("ties"),
    ]
    return marked.groupBy(*groups).agg(*aggs) if groups else marked.agg(*aggs)


# Topics

def question_text(df: DataFrame, names: Sequence[str] = ("input", "question", "text")) -> Column:
    """The first of the named columns that holds a value."""
    have = [F.col(n) for n in names if n in df.columns]
    if not have:
        raise ValueError(f"needs one of {list(names)}; available: {df.columns}")
    return F.coalesce(*have)


def topic_counts(df: DataFrame, topics: str = "topics", groups: Sequence[str] = ()) -> DataFrame:
    """How often each topic occurs; records without a question are skipped."""
    asked = df.filter(F.coalesce(F.trim(question_text(df)) != "", F.lit(False)))
    return _topic_rows(asked, topics, *groups).groupBy(*groups, "topic").agg(F.count("*").alias("n"))


def _topic_rows(df: DataFrame, topics: str, *rest) -> DataFrame:
    """One row per topic. The outer form keeps the planner from computing the array again for a filter on its size."""
    return df.select(*rest, F.explode_outer(topics).alias("topic")).filter(F.col("topic").isNotNull())


def topic_coverage(df: DataFrame, is_gold: Column, topics: str = "topics") -> DataFrame:
    """(topic, gold_count, generated_count) of the gold and the generated questions of one table, in one
    aggregation. Union two tables with a flag to compare them."""
    asked = df.filter(F.coalesce(F.trim(question_text(df)) != "", F.lit(False)))
    return _topic_rows(asked, topics, is_gold.alias("_g")).groupBy("topic").agg(
        F.count_if("_g").alias("gold_count"), F.count_if(~F.col("_g")).alias("generated_count")
    )


def missing_topics(coverage: DataFrame) -> DataFrame:
    """Gold topics the generated questions never touch."""
    return coverage.filter("gold_count > 0 AND generated_count = 0").select("topic", "gold_count")


def underrepresented_topics(coverage: DataFrame) -> DataFrame:
    """Topics of both sets whose gold count exceeds the generated one by more than half; and by how much."""
    both = coverage.filter("generated_count > 0").filter(F.col("gold_count") > UNDER_FACTOR * F.col("generated_count"))
    return both.select("topic", (F.col("gold_count") - F.col("generated_count")).alias("shortfall"))


def topic_batches(coverage: DataFrame, per_topic: int = 2, **options) -> DataFrame:
    """Topics to cover, missing ones first, three to a batch, with the number of questions to ask for."""
    missing = (F.col("gold_count") > 0) & (F.col("generated_count") == 0)
    under = (F.col("generated_count") > 0) & (F.col("gold_count") > UNDER_FACTOR * F.col("generated_count"))
    gaps = coverage.filter(missing | under).select("topic", "gold_count", "generated_count", F.when(missing, 0).otherwise(1).alias("_o"))
    # Stored because numbering reads it twice, and it is far smaller than the questions behind it.
    batched = assign_batches(materialise(gaps, "gaps"), TOPICS_PER_BATCH, ["_o", "topic"], **options)
    listed = batched.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("_o", "topic", "gold_count", "generated_count"))).alias("_ts"))
    counts = lambda c: F.array_join(F.transform("_ts", lambda t: F.concat(t["topic"], F.lit(": "), t[c].cast("string"))), ", ")
    return listed.select(
        "batch",
        F.array_join(F.transform("_ts", lambda t: t["topic"]), ",").alias("topics"),
        (F.size("_ts") * per_topic).cast("long").alias("num_questions"),
        counts("gold_count").alias("gold"), counts("generated_count").alias("generated"),
    )


# SQL errors

def sql_error_type(message: Column) -> Column:
    text = F.lower(message)
    out = F
    for name, needles in SQL_ERROR_RULES:
        hit = F.contains(text, F.lit(needles[0]))
        for needle in needles[1:]:
            hit = hit & F.contains(text, F.lit(needle))
        out = out.when(hit, name)
    return out.otherwise("other")


def sql_feature_flags(sql: Column) -> Mapping[str, Column]:
    text = F.lower(sql)
    calls = F.lit(False)
    for call in AGGREGATE_CALLS:
        calls = calls | F.contains(text, F.lit(call))
    return {
        "join": text.contains("join"),
        "cte": text.contains("with") & text.contains("as"),
        "subquery": F.size(F.split(text, "select")) > 2,
        "group_by": text.contains("group by"),
        "aggregation": calls,
    }


def sql_features(df: DataFrame, sql: str = "generated_sql") -> DataFrame:
    """How many queries use each feature, as rows (feature, n), in one pass."""
    return _counts_as_rows(df, sql_feature_flags(F.col(sql)), "feature")


def _counts_as_rows(df: DataFrame, flags: Mapping[str, Column], name: str) -> DataFrame:
    counted = df.agg(*[F.count_if(F.coalesce(f, F.lit(False))).alias(n) for n, f in flags.items()])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(n).alias(name), F.col(n).alias("n")) for n in flags])))


def error_types(df: DataFrame, message: str = "error_message") -> DataFrame:
    return df.groupBy(sql_error_type(F.col(message)).alias("error_type")).agg(F.count("*").alias("n"))


def _corrected(df: DataFrame) -> Column:
    return F.coalesce(F.col("was_corrected"), F.lit(False)) if "was_corrected" in df.columns else F.lit(False)


def correction_stats(df: DataFrame) -> DataFrame:
    """Failed queries in total and by whether they were corrected; unknown counts as not corrected."""
    fixed = _corrected(df)
    return df.agg(
        F.count("*").alias("total"), F.count_if(fixed).alias("corrected"), F.count_if(~fixed).alias("not_corrected")
    )


def failure_digest(df: DataFrame, order_by: str) -> DataFrame:
    """One prompt: statistics of all failed queries and the first few of them as examples."""
    return failure_parts(df, order_by).select(F.concat_ws("\n\n", "basic_stats", "sample_queries").alias("prompt"))


def failure_parts(df: DataFrame, order_by: str) -> DataFrame:
    """One row of ``basic_stats`` of all failed queries, in one pass, and ``sample_queries``, the first few of them."""
    fields = ["question", "generated_sql", "error_message"]
    first = df.select(order_by, *fields).orderBy(order_by).limit(DIGEST_QUERIES)
    listed = first.agg(F.array_sort(F.collect_list(F.struct(order_by, *fields))).alias("_e"))
    examples = F.array_join(
        F.transform("_e", lambda e, i: F.concat(
            F.lit("Query "), (i + 1).cast("string"), F.lit("\nQuestion: "), e["question"],
            F.lit("\nSQL: "), e["generated_sql"], F.lit("\nError: "), e["error_message"], F.lit("\n"))),
        "\n",
    )
    # The rules are few and fixed, so each type and feature is a counter of one aggregate row.
    kind = sql_error_type(F.col("error_message"))
    counters = {
        "types": {n: kind == n for n in sorted([name for name, _ in SQL_ERROR_RULES] + ["other"])},
        "features": dict(sorted(sql_feature_flags(F.col("generated_sql")).items())),
    }
    fixed = _corrected(df)
    stats = df.agg(
        F.count("*").alias("total"), F.count_if(fixed).alias("corrected"),
        *[
            F.array(*[F.struct(F.lit(n).alias("name"), F.count_if(F.coalesce(f, F.lit(False))).alias("n")) for n, f in flags.items()]).alias(group)
            for group, flags in counters.items()
        ],
    )

    def shown(group: str) -> Column:
        present = F.filter(group, lambda c: c["n"] > 0)
        return F.array_join(F.transform(present, lambda c: F.concat(c["name"], F.lit("="), c["n"].cast("string"))), ", ")

    # Both sides are a single aggregate row.
    both = stats.withColumn("_one", F.lit(1)).join(listed.select(examples.alias("examples"), F.lit(1).alias("_one")), "_one")
    return both.select(F.concat(
        F.format_string("Failed queries: %d\n", F.col("total")),
        F.lit("Error types: "), shown("types"),
        F.lit("\nSQL features: "), shown("features"),
        F.format_string("\nCorrected: %d, not corrected: %d", F.col("corrected"), F.col("total") - F.col("corrected")),
    ).alias("basic_stats"), F.col("examples").alias("sample_queries"))


# The messages of the validity check.
NO_QUERY, EMPTY_QUERY = "No SQL query provided", "Empty SQL query"
VALID, INVALID = "Query is valid and can be executed", "Query is invalid: "


def sql_validity(sql: Column) -> Column:
    """Struct (is_valid, error, explanation, sql) of the checks that need no database. A query of comments alone is empty."""
    error = F.when(F.coalesce(sql, F.lit("")) == "", NO_QUERY).when(is_blank(sql), EMPTY_QUERY)
    return F.struct(
        error.isNull().alias("is_valid"),
        error.alias("error"),
        F.when(error.isNull(), VALID).otherwise(F.concat(F.lit(INVALID), error)).alias("explanation"),
        F.when(error.isNull(), terminate_sql(sql)).alias("sql"),
    )
