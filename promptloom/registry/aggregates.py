"""Evaluation aggregates, SQL error statistics and classifiers."""

from pyspark.sql import functions as F

from promptloom.operators import classify, evaluate
from promptloom.registry.base import query
from promptloom.registry.reshaping import FAILED_SQL, failed_sql
from promptloom.sources import datasets

# Answers derived from the tables: a product answer is wrong for every tenth part, a value answer lacks its
# units on line 7, a code answer is absent in region 0.
_PRODUCT = """SELECT p_partkey AS id, 'products' AS task, p_partkey % 10 <> 0 AS is_exact_match,
  CASE WHEN p_partkey % 10 <> 0 THEN 5 ELSE 3 END AS score FROM part"""
_VALUE = """SELECT l_orderkey * 10 + l_linenumber AS id, 'earnings' AS task, l_linenumber <> 7 AS is_exact_match,
  CASE WHEN l_linenumber <> 7 THEN 5 ELSE 2 END AS score FROM lineitem"""
_ALL = f"{_PRODUCT} UNION ALL {_VALUE}"


def product_answers(t):
    answered = F.when(F.col("p_partkey") % 10 == 0, F.col("p_partkey") + 1).otherwise(F.col("p_partkey"))
    match = evaluate.all_equal((answered, F.col("p_partkey")))
    return t.part.select(F.col("p_partkey").alias("id"), F.lit("products").alias("task"), match.alias("is_exact_match"),
                         F.when(match, 5).otherwise(3).alias("score"))


def value_answers(t):
    units = F.when(F.col("l_linenumber") != 7, F.col("l_returnflag"))
    match = evaluate.all_equal((units, F.col("l_returnflag")), (F.col("l_quantity"), F.col("l_quantity")))
    return t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.lit("earnings").alias("task"),
                             match.alias("is_exact_match"), F.when(match, 5).otherwise(2).alias("score"))


@query("exact_match_product", _PRODUCT)
def exact_match_product(t):
    return product_answers(t)


@query("exact_match_value", _VALUE)
def exact_match_value(t):
    return value_answers(t)


@query("exact_match_code", "SELECT n_nationkey, n_regionkey <> 0 AS is_exact_match FROM nation")
def exact_match_code(t):
    code = F.when(F.col("n_regionkey") != 0, F.col("n_name"))
    return t.nation.select("n_nationkey", evaluate.all_equal((code, F.col("n_name"))).alias("is_exact_match"))


@query("eval_scores", f"""
SELECT task, round(avg(score), 6) AS mean_score, round(avg(CAST(is_exact_match AS INT)), 6) AS precision, count(*) AS n_answers
FROM ({_ALL}) GROUP BY task""")
def eval_scores(t):
    scores = evaluate.score_tasks(product_answers(t).unionByName(value_answers(t)))
    return scores.withColumns({c: F.round(c, 6) for c in ("mean_score", "precision")})


@query("eval_summary", f"""
WITH s AS (SELECT task, avg(score) AS s, avg(CAST(is_exact_match AS INT)) AS p FROM ({_ALL}) GROUP BY task)
SELECT 0 AS metric_no, 'product_response_subjective_score' AS metric, (SELECT round(s, 6) FROM s WHERE task = 'products') AS value
UNION ALL SELECT 1, 'product_id_precision_score', (SELECT round(p, 6) FROM s WHERE task = 'products')
UNION ALL SELECT 2, 'earnings_response_subjective_score', (SELECT round(s, 6) FROM s WHERE task = 'earnings')
UNION ALL SELECT 3, 'earnings_precision_score', (SELECT round(p, 6) FROM s WHERE task = 'earnings')
UNION ALL SELECT 4, 'icd11_response_subjective_score', -1.0 UNION ALL SELECT 5, 'icd11_precision_score', -1.0""")
def eval_summary(t):
    """The code task has no answers here, so its metrics show as absent."""
    scores = evaluate.score_tasks(product_answers(t).unionByName(value_answers(t)))
    return evaluate.summarise(scores).withColumn("value", F.round("value", 6))


_COMPARE = """SELECT count(*) AS n, round(avg(CAST(t AS INT)), 6) AS test_accuracy, round(avg(CAST(b AS INT)), 6) AS base_accuracy,
  CAST(count_if(t AND NOT b) AS BIGINT) AS wins, CAST(count_if(NOT t AND b) AS BIGINT) AS losses, CAST(count_if(t = b) AS BIGINT) AS ties"""


@query("classifier_compare", f"""
{_COMPARE} FROM (SELECT quality = CAST(n_chars >= 200 AS INT) AS t, quality = CAST(lang = 'en' AS INT) AS b FROM documents JOIN labels USING (doc_id))""")
def classifier_compare(t):
    rows = t.labels.join(t.documents.select("doc_id", "n_chars", "lang"), "doc_id").select(
        F.col("quality").alias("target"), (F.col("n_chars") >= 200).cast("int").alias("test_output"),
        (F.col("lang") == "en").cast("int").alias("base_output"),
    )
    out = evaluate.compare_classifiers(rows)
    return out.withColumns({c: F.round(c, 6) for c in ("test_accuracy", "base_accuracy")})


def _similar_sql(a, b):
    return f"1 - levenshtein(lower({a}), lower({b})) / greatest(length({a}), length({b})) >= 0.6"


@query("classifier_compare_fuzzy", f"""
SELECT p_type AS kind, * EXCLUDE (p_type) FROM ({_COMPARE}, p_type FROM (
  SELECT p_type, {_similar_sql("p_name", "p_name || ' x'")} AS t, {_similar_sql("p_name", "p_type || ' ' || p_name")} AS b FROM part) GROUP BY p_type)""")
def classifier_compare_fuzzy(t):
    rows = t.part.select(
        F.col("p_type").alias("kind"), F.col("p_name").alias("target"),
        F.concat(F.col("p_name"), F.lit(" x")).alias("test_output"), F.concat_ws(" ", "p_type", "p_name").alias("base_output"),
    )
    out = evaluate.compare_classifiers(rows, fuzzy=0.6, groups=["kind"])
    return out.withColumns({c: F.round(c, 6) for c in ("test_accuracy", "base_accuracy")})


# SQL errors

_ERRORS = """SELECT event_id, 'Q' || event_id AS question, 'SELECT ' || user_id || CASE WHEN value > 10 THEN ', sum(v) FROM a JOIN b GROUP BY 1'
  WHEN value > 5 THEN ' FROM (SELECT 1)' ELSE '' END AS sql,
  CASE CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 7 WHEN 0 THEN 'Syntax error at x' WHEN 1 THEN 'Column a does not exist'
  WHEN 2 THEN 'invalid identifier b' WHEN 3 THEN 'schema c does not exist' WHEN 4 THEN 'unknown function d'
  WHEN 5 THEN 'must appear in GROUP BY' ELSE 'timeout' END AS message, user_id % 2 = 0 AS fixed FROM events WHERE event_type = 'error'"""
_TYPES = f"""SELECT CASE WHEN contains(message, 'Syntax') THEN 'syntax_error' WHEN contains(message, 'Column') THEN 'missing_column'
  WHEN contains(message, 'identifier') THEN 'invalid_identifier' WHEN contains(message, 'schema') THEN 'schema_error'
  WHEN contains(message, 'function') THEN 'function_error' WHEN contains(message, 'GROUP') THEN 'group_by_error' ELSE 'other' END AS error_type,
  count(*) AS n FROM ({_ERRORS}) GROUP BY 1"""
_FEATURES = f"""SELECT unnest(['join', 'cte', 'subquery', 'group_by', 'aggregation']) AS feature, CAST(unnest([a, 0, b, a, a]) AS BIGINT) AS n FROM (
  SELECT count_if(contains(sql, 'JOIN')) AS a, count_if(contains(sql, '(SELECT')) AS b FROM ({_ERRORS}))"""


def sql_errors(t):
    kind = F.regexp_extract("props", "([0-9]+)", 1).cast("long") % 7
    texts = ["Syntax error at x", "Column a does not exist", "invalid identifier b", "schema c does not exist", "unknown function d",
             "must appear in GROUP BY", "timeout"]
    message = F.element_at(F.array(*[F.lit(m) for m in texts]), (kind + 1).cast("int"))
    tail = F.when(F.col("value") > 10, ", sum(v) FROM a JOIN b GROUP BY 1").when(F.col("value") > 5, " FROM (SELECT 1)").otherwise("")
    return t.events.filter("event_type = 'error'").select(
        "event_id", F.concat(F.lit("Q"), F.col("event_id")).alias("question"),
        F.concat(F.lit("SELECT "), F.col("user_id"), tail).alias("generated_sql"), message.alias("error_message"),
        (F.col("user_id") % 2 == 0).alias("was_corrected"),
    )


@query("sql_error_types", _TYPES)
def sql_error_types(t):
    return evaluate.error_types(sql_errors(t))


@query("sql_features", _FEATURES)
def sql_features(t):
    return evaluate.sql_features(sql_errors(t))


@query("sql_features_of_failures", f"""
SELECT unnest(['join', 'cte', 'subquery', 'group_by', 'aggregation']) AS feature, CAST(unnest([0, n, n, 0, 0]) AS BIGINT) AS n FROM (
  SELECT count_if(starts_with(generated_sql, 'WITH')) AS n FROM ({FAILED_SQL}))""")
def sql_features_of_failures(t):
    return evaluate.sql_features(failed_sql(t))


@query("correction_stats", f"""
SELECT count(*) AS total, CAST(count_if(fixed) AS BIGINT) AS corrected, CAST(count_if(NOT fixed) AS BIGINT) AS not_corrected FROM ({_ERRORS})""")
def correction_stats(t):
    return evaluate.correction_stats(sql_errors(t))


@query("failure_digest", f"""
SELECT 'Failed queries: ' || (SELECT count(*) FROM ({_ERRORS})) || chr(10)
  || 'Error types: ' || (SELECT string_agg(error_type || '=' || n, ', ' ORDER BY error_type) FROM ({_TYPES})) || chr(10)
  || 'SQL features: ' || (SELECT string_agg(feature || '=' || n, ', ' ORDER BY feature) FROM ({_FEATURES}) WHERE n > 0) || chr(10)
  || 'Corrected: ' || (SELECT count_if(fixed) FROM ({_ERRORS})) || ', not corrected: ' || (SELECT count_if(NOT fixed) FROM ({_ERRORS})) || chr(10) || chr(10)
  || (SELECT string_agg('Query ' || i || chr(10) || 'Question: ' || question || chr(10) || 'SQL: ' || sql || chr(10) || 'Error: ' || message || chr(10), chr(10) ORDER BY i)
      FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS i FROM ({_ERRORS})) WHERE i <= 5) AS prompt""")
def failure_digest(t):
    """The statistics cover every failed query; the five examples are the digest's own limit."""
    return evaluate.failure_digest(sql_errors(t), "event_id")


# Classes

@query("class_registry", """
SELECT CAST(row_number() OVER (ORDER BY f) - 1 AS INT) AS class_id, label AS class_name FROM (SELECT label, min(vec_id) AS f FROM embeddings GROUP BY label)""")
def class_registry(t):
    return classify.class_registry(t.embeddings, "label", "vec_id")


@query("fewshot_examples", """
SELECT lang, string_agg(text, chr(10) ORDER BY r) AS examples FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || doc_id), doc_id) AS r FROM documents) WHERE r <= 2 GROUP BY lang""")
def fewshot_examples(t):
    return classify.few_shot(t.documents, "lang", "doc_id", "text", seed=7)


@query("class_examples", """
SELECT lang AS class_name, line_no, string_agg(text, chr(30) ORDER BY doc_id) AS examples, count(*) AS n FROM (
  SELECT *, CAST(floor((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) / 100) AS BIGINT) AS line_no FROM documents) GROUP BY lang, line_no""")
def class_examples(t):
    lines = datasets.class_example_lines(t.documents, "lang", "text", "doc_id", 100)
    return lines.select("class_name", "line_no", F.array_join("examples", "\x1e").alias("examples"), F.size("examples").cast("long").alias("n"))


@query("augment_need", """
SELECT lang AS class_name, count(*) AS have, greatest(300 - count(*), 0) AS need FROM documents GROUP BY lang""")
def augment_need(t):
    return classify.examples_needed(t.documents.select(F.col("lang").alias("class_name")), 300)


@query("augment_examples", """
WITH n AS (SELECT lang, greatest(300 - count(*), 0) AS need FROM documents GROUP BY lang)
SELECT lang AS class_name, text AS example, false AS is_new FROM documents
UNION ALL SELECT lang, 'new ' || lang || ' ' || lpad(CAST(i AS VARCHAR), 4, '0'), true FROM (
  SELECT lang, unnest(range(1, need + 1)) AS i FROM n)""")
def augment_examples(t):
    """Two rounds of made-up examples: the first gives too few, the second more than enough."""
    def fill(first, last):
        def make(need):
            no = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("i")
            label = F.concat(F.lit("new "), F.col("class_name"), F.lit(" "), F.lpad(F.col("i").cast("string"), 4, "0"))
            return need.select("class_name", no).select("class_name", label.alias("example"), label.alias("sort_key"))
        return make

    rows = t.documents.select(F.col("lang").alias("class_name"), F.col("text").alias("example"))
    return classify.augment_examples(rows, 300, [fill(1, 10), fill(11, 1000)])


def fitted(t):
    rows = t.embeddings.select("vec_id", "embedding", F.col("label").alias("class_name"))
    return classify.EmbeddingClassifier.fit(rows, classify.class_registry(rows, position="vec_id")), rows


@query("classifier_train_metrics")
def classifier_train_metrics(t):
    """Accuracy on the training rows; learned, so there is no oracle."""
    classifier, rows = fitted(t)
    named = classifier.predict(rows.withColumnRenamed("class_name", "target"))
    return named.agg(F.count("*").alias("n"), F.round(F.avg((F.col("target") == F.col("class_name")).cast("int")), 4).alias("accuracy"))


@query("classifier_proba")
def classifier_proba(t):
    classifier, rows = fitted(t)
    return classifier.long_probabilities(rows.drop("class_name"), ["vec_id"]).withColumn("prob", F.round("prob", 4))


@query("classifier_predict")
def classifier_predict(t):
    classifier, rows = fitted(t)
    return classifier.predict(rows.drop("class_name")).select("vec_id", "class_id", "class_name")


@query("classifier_mass", "SELECT label AS class_name, CAST(count(*) AS DOUBLE) AS expected FROM embeddings WHERE embedding IS NOT NULL GROUP BY label")
def classifier_mass(t):
    """At the optimum of the objective, whose intercepts are free, the probabilities of a class sum to its number of training rows."""
    classifier, rows = fitted(t)
    probs = classifier.long_probabilities(rows.drop("class_name"), ["vec_id"])
    return probs.groupBy("class_name").agg(F.round(F.sum("prob"), 1).alias("expected"))


@query("classifier_separable", "SELECT doc_id, lang AS class_name FROM documents")
def classifier_separable(t):
    """A vector that names its class is classified right."""
    rows = t.documents.select("doc_id", F.col("lang").alias("class_name"), F.array(*[
        (F.col("lang") == x).cast("float") for x in ("de", "en", "es", "fr")]).alias("embedding"))
    classifier = classify.EmbeddingClassifier.fit(rows, classify.class_registry(rows, position="doc_id"))
    return classifier.predict(rows.drop("class_name")).select("doc_id", "class_name")
