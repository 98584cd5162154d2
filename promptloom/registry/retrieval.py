"""Nearest neighbours, index tables, joins between topic sets, result comparison and catalog checks."""

from pyspark.sql import functions as F

from promptloom.operators import catalog, classify, compare, evaluate, inference
from promptloom.operators import retrieval as ret
from promptloom.registry.base import embedded_sql, q, query, squared_distance_sql
from promptloom.sources import tables
from promptloom.storage import materialise, scratch_path
from promptloom.testing.doubles import echo_model, letter_encoder

_KNN = f"""
SELECT vec_id, rank, split_id, distance FROM (
  SELECT a.vec_id, b.vec_id AS split_id, {squared_distance_sql('a.embedding', 'b.embedding')} AS distance,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY {squared_distance_sql('a.embedding', 'b.embedding')}, b.vec_id) AS rank
  FROM embeddings a, embeddings b) WHERE rank <= 5"""


def neighbours(t, k=5):
    index = t.embeddings.select(F.col("vec_id").alias("split_id"), "embedding")
    return ret.nearest(t.embeddings, index, k, "vec_id")


@query("knn_l2", f"SELECT vec_id, CAST(rank AS INT) AS rank, split_id, round(distance, 6) AS distance FROM ({_KNN})")
def knn_l2(t):
    """Every vector as a query against every vector."""
    return neighbours(t).withColumn("distance", F.round("distance", 6))


@query("knn_l2_pruned", f"SELECT vec_id, CAST(rank AS INT) AS rank, split_id, round(distance, 6) AS distance FROM ({_KNN})")
def knn_l2_pruned(t):
    """The same with small cells, so that queries visit several of them, in rounds."""
    index = t.embeddings.select(F.col("vec_id").alias("split_id"), "embedding")
    return ret.nearest(t.embeddings, index, 5, "vec_id", cell_rows=64).withColumn("distance", F.round("distance", 6))


@query("augment_prompt", f"""
SELECT vec_id, 'Query ' || vec_id || ': ' || string_agg('vec ' || split_id || ' label ' || label, chr(10) ORDER BY rank) AS prompt
FROM ({_KNN}) h JOIN (SELECT vec_id AS id, label FROM embeddings) e ON e.id = h.split_id GROUP BY vec_id""")
def augment_prompt(t):
    prompts = t.embeddings.select("vec_id", F.format_string("Query %d: ", "vec_id").alias("prompt"))
    splits = t.embeddings.select(F.col("vec_id").alias("split_id"), F.format_string("vec %d label %d", "vec_id", "label").alias("split"))
    return ret.augment_prompts(prompts, neighbours(t).join(splits, "split_id"), "vec_id")


_CHUNKS = f"""
WITH c AS (SELECT substring(text, CAST(i * 1024 + 1 AS BIGINT), 1024) AS chunk FROM (
  SELECT text, unnest(range(CAST(ceil(length(text) / 1024.0) AS BIGINT))) AS i FROM documents)),
e AS ({embedded_sql("c", "1 AS one", "chunk")})"""
DIMENSIONS = range(1, 27)
ALL_DIMENSIONS = ", ".join(f"round(CAST(e[{n}] AS DOUBLE), 6) AS e{n}" for n in DIMENSIONS)


def all_dimensions(index):
    return index.select("split", *[F.round(F.element_at("embedding", n).cast("double"), 6).alias(f"e{n}") for n in DIMENSIONS])


@query("build_index", f"{_CHUNKS} SELECT chunk AS split, {ALL_DIMENSIONS} FROM e")
def build_index(t):
    return all_dimensions(ret.build_index(t.documents, letter_encoder))


@query("index_append", f"""
WITH e AS ({embedded_sql("documents", "doc_id", "text")}) SELECT text AS split, {ALL_DIMENSIONS} FROM e""")
def index_append(t):
    """English documents form the index; then all documents are added, of which the English ones are known."""
    path = scratch_path(t.spark, "index")
    ret.save_index(ret.index_rows(t.documents.filter("lang = 'en'"), "text", letter_encoder, ["doc_id"]), path)
    ret.append_to_index(t.documents, path, "text", letter_encoder, ["doc_id"])
    return all_dimensions(ret.load_index(t.spark, path))


@query("index_search", f"""
WITH d AS ({embedded_sql("documents", "doc_id", "text")}), b AS ({embedded_sql("benchmark", "item_id", "text")}),
h AS (SELECT b.item_id, d.text AS split, {squared_distance_sql('b.e', 'd.e')} AS distance FROM b, d)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY distance, sha256('{{"_text":' || to_json(split) || '}}')) AS INT) AS rank,
  round(distance, 6) AS distance FROM h QUALIFY rank <= 5""")
def index_search(t):
    """A stored index grown in three appends, searched by cell: every benchmark text against every document."""
    path = scratch_path(t.spark, "index")
    for part in range(3):
        ret.append_to_index(t.documents.filter(F.col("doc_id") % 3 == part), path, "text", letter_encoder, ["doc_id"])
    asked = inference.embed(t.benchmark, letter_encoder, "text").select("item_id", "embedding")
    return ret.nearest(asked, ret.open_index(t.spark, path), 5, "item_id").select("item_id", "rank", F.round("distance", 6).alias("distance"))


@query("rag_answer", f"""
WITH d AS ({embedded_sql("documents", "doc_id", "text")}), b AS ({embedded_sql("benchmark", "item_id", "text")}),
h AS (SELECT b.item_id, b.text AS question, d.text AS split, row_number() OVER (PARTITION BY b.item_id ORDER BY {squared_distance_sql('b.e', 'd.e')}, d.doc_id) AS rank
      FROM b, d),
p AS (SELECT item_id, question || string_agg(split, chr(10) ORDER BY rank) AS prompt FROM h WHERE rank <= 3 GROUP BY item_id, question)
SELECT item_id, length(prompt) || ':' || prompt AS response FROM p""")
def rag_answer(t):
    """Every benchmark text as a question over every document, answered by the echo double."""
    docs = t.documents.select(F.col("doc_id").alias("split_id"), F.col("text").alias("split"))
    index = materialise(inference.embed(docs, letter_encoder, "split"), "index")
    asked = ret.rag_prompts(t.benchmark.select("item_id", F.col("text").alias("prompt")), index, letter_encoder, 3, "item_id")
    return inference.generate(asked, echo_model).select("item_id", "response")


# Topics: the lower-cased words of a text. Gold questions come from sources src0–src9, generated ones from the others.
_WORDS = "SELECT unnest(string_split_regex(lower(text), '\\s+')) AS topic, regexp_matches(source, '^src[0-9]$') AS is_gold FROM documents WHERE trim(text) <> ''"
_GOLD = f"SELECT topic, count(*) AS n FROM ({_WORDS}) WHERE is_gold GROUP BY topic"
_MADE = f"SELECT topic, count(*) AS n FROM ({_WORDS}) WHERE NOT is_gold GROUP BY topic"
_MISSING = f"SELECT g.topic, g.n AS gold_count FROM ({_GOLD}) g WHERE g.topic NOT IN (SELECT topic FROM ({_MADE}))"
_UNDER = f"SELECT g.topic, g.n - m.n AS shortfall FROM ({_GOLD}) g JOIN ({_MADE}) m ON g.topic = m.topic WHERE g.n > 1.5 * m.n"


def questions(t):
    return t.documents.select(
        "text", F.split(F.lower("text"), r"\s+").alias("topics"), F.col("source").rlike("^src[0-9]$").alias("is_gold")
    )


def coverage(t):
    return evaluate.topic_coverage(questions(t), F.col("is_gold"))


@query("topic_counts", f"SELECT is_gold, topic, count(*) AS n FROM ({_WORDS}) GROUP BY ALL")
def topic_counts(t):
    return evaluate.topic_counts(questions(t), groups=["is_gold"])


@query("missing_topics", _MISSING)
def missing_topics(t):
    return evaluate.missing_topics(coverage(t))


@query("underrepresented_topics", _UNDER)
def underrepresented_topics(t):
    return evaluate.underrepresented_topics(coverage(t))


# Topics with their counts on both sides, missing ones (o = 0) before under-represented ones.
_GAPS = f"""SELECT topic, 0 AS o, gold_count AS n, 0 AS m FROM ({_MISSING})
  UNION ALL SELECT g.topic, 1, g.n, m.n FROM ({_GOLD}) g JOIN ({_MADE}) m ON g.topic = m.topic WHERE g.n > 1.5 * m.n"""
_BATCHES = f"""
SELECT batch, string_agg(topic, ',' ORDER BY o, topic) AS topics, CAST(count(*) * 2 AS BIGINT) AS num_questions,
  string_agg(topic || ': ' || n, ', ' ORDER BY o, topic) AS gold, string_agg(topic || ': ' || m, ', ' ORDER BY o, topic) AS generated FROM (
  SELECT *, CAST(floor((row_number() OVER (ORDER BY o, topic) - 1) / 3) AS BIGINT) AS batch FROM ({_GAPS})) GROUP BY batch"""


@query("topic_batches", _BATCHES)
def topic_batches(t):
    return evaluate.topic_batches(coverage(t))


# Result comparison

GOLD_REVENUE = "SELECT c_nationkey AS nation, sum(o_totalprice) AS revenue, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey"
OPEN_REVENUE = GOLD_REVENUE.replace(" GROUP", " WHERE o_orderstatus = 'O' OR c_nationkey < 5 GROUP")
CASES = [
    compare.SqlCase("Revenue by nation", GOLD_REVENUE, GOLD_REVENUE + ";"),
    compare.SqlCase(
        "Revenue by nation, joined the other way round", GOLD_REVENUE,
        "SELECT c_nationkey AS nation, sum(o_totalprice) AS revenue, count(o_orderkey) AS n FROM customer, orders WHERE o_custkey = c_custkey GROUP BY 1",
    ),
    compare.SqlCase("Revenue by nation, wrong filter", GOLD_REVENUE, OPEN_REVENUE),
    compare.SqlCase("Line count", "SELECT count(*) AS n FROM lineitem", "SELECT count(*) AS n, 1 AS extra FROM lineitem"),
    compare.SqlCase("Line items by flag", "SELECT l_returnflag, l_shipdate, l_quantity FROM lineitem",
                    "SELECT l_returnflag, l_shipdate, l_quantity FROM lineitem ORDER BY l_orderkey"),
    compare.SqlCase("Neighbours in a region", "SELECT a.n_name, b.n_name FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey",
                    "SELECT x.n_name, y.n_name FROM nation y, nation x WHERE x.n_regionkey = y.n_regionkey"),
    compare.SqlCase("Unknown column", "SELECT n_name FROM nation", "SELECT nation_name FROM nation"),
    compare.SqlCase("Not SQL", "SELECT r_name FROM region", "SELEC r_name FROM region"),
]


def _rounded(sql):
    return f"SELECT CAST(nation AS BIGINT) AS nation, round(revenue, 6) AS revenue, n FROM ({sql})"


_LEFT, _RIGHT = _rounded(GOLD_REVENUE), _rounded(OPEN_REVENUE)
_DIFF = f"""
SELECT CAST(nation AS BIGINT) AS nation, revenue, n, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right FROM (
  SELECT nation, round(revenue, 2) AS revenue, n, 1 AS l, 0 AS r FROM ({GOLD_REVENUE})
  UNION ALL SELECT nation, round(revenue, 2), n, 0, 1 FROM ({OPEN_REVENUE})) GROUP BY ALL HAVING sum(l) <> sum(r)"""


def register_tables(t):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    tables.register({n: getattr(t, n) for n in names})


@query("result_diff", _DIFF)
def result_diff(t):
    register_tables(t)
    return compare.result_diff(tables.execute_query(t.spark, GOLD_REVENUE), tables.execute_query(t.spark, OPEN_REVENUE), 2)


@query("sql_score", f"""
SELECT count(*) = 0 AS is_similar, CAST(sum(greatest(n_right - n_left, 0)) AS BIGINT) AS n_extra,
       CAST(sum(greatest(n_left - n_right, 0)) AS BIGINT) AS n_missing FROM ({_DIFF})""")
def sql_score(t):
    register_tables(t)
    return compare.score_against(tables.execute_query(t.spark, OPEN_REVENUE), tables.execute_query(t.spark, GOLD_REVENUE), 2)


def _case_sql(no, case):
    """Expected outcome, with the number of differing rows counted by the oracle's own engine."""
    gold, made = (compare._bare(s) for s in (case.gold_query, case.generated_query))
    head = f"SELECT {no} AS case_no, {q(case.question)} AS question, "
    if case.question in ("Unknown column", "Not SQL"):
        return head + "'error' AS status, false AS equivalent, 0.0::DOUBLE AS confidence, CAST(NULL AS BIGINT) AS n_different"
    if case.question == "Line count":
        return head + "'success', false, 0.5::DOUBLE, CAST(NULL AS BIGINT)"
    if "revenue" in gold:
        gold, made = (f"SELECT nation, round(revenue, 2) AS revenue, n FROM ({s})" for s in (gold, made))
    n = f"((SELECT count(*) FROM (SELECT * FROM ({gold}) EXCEPT ALL SELECT * FROM ({made}))) + (SELECT count(*) FROM (SELECT * FROM ({made}) EXCEPT ALL SELECT * FROM ({gold}))))"
    return head + f"'success' AS status, {n} = 0 AS equivalent, CASE WHEN {n} = 0 THEN 1.0 ELSE 0.5 END::DOUBLE AS confidence, {n} AS n_different"


_CASES = " UNION ALL ".join(_case_sql(i, c) for i, c in enumerate(CASES, 1))
_STATS = f"""
SELECT count(*) AS total, count(*) FILTER (status = 'success' AND equivalent) AS equivalent,
       count(*) FILTER (status = 'success' AND NOT equivalent) AS non_equivalent,
       count(*) FILTER (status = 'error') AS execution_errors,
       sum(confidence) / count(*) AS average_confidence,
       count(*) FILTER (status = 'success' AND equivalent) / count(*) AS equivalence_rate FROM ({_CASES})"""


def case_results(t):
    register_tables(t)
    return compare.evaluate_sql_pairs(t.spark, CASES, 2)


@query("sql_pair_eval", _CASES)
def sql_pair_eval(t):
    """Differing rows count once per distinct row, which here equals the multiset difference."""
    return case_results(t).select("case_no", "question", "status", "equivalent", "confidence", "n_different")


@query("sql_eval_stats", f"SELECT * REPLACE (round(average_confidence, 6) AS average_confidence, round(equivalence_rate, 6) AS equivalence_rate) FROM ({_STATS})")
def sql_eval_stats(t):
    stats = compare.sql_pair_stats(case_results(t))
    return stats.withColumns({c: F.round(c, 6) for c in ("average_confidence", "equivalence_rate")})


# Names of Spark's own error conditions, for the queries that do not run.
_CONDITIONS = {"Unknown column": "UNRESOLVED_COLUMN.WITH_SUGGESTION", "Not SQL": "PARSE_SYNTAX_ERROR"}
_TEXTS = " UNION ALL ".join(
    f"SELECT {i} AS case_no, {q(_CONDITIONS.get(c.question, ''))} AS condition, {q(c.gold_query)} AS gold, {q(c.generated_query)} AS made" for i, c in enumerate(CASES, 1))


@query("sql_eval_report", f"""
SELECT 0 AS line_no, printf('# SQL query evaluation' || chr(10) || '- Test cases: %d' || chr(10) || '- Equivalent: %d (%.1f%%)' || chr(10)
  || '- Not equivalent: %d (%.1f%%)' || chr(10) || '- Errors: %d (%.1f%%)' || chr(10) || '- Average confidence: %.2f',
  total, equivalent, 100 * equivalent / total, non_equivalent, 100 * non_equivalent / total, execution_errors, 100 * execution_errors / total,
  round(average_confidence, 2)) AS line FROM ({_STATS})
UNION ALL SELECT case_no, printf('## Case %d: ', case_no) || question || chr(10) || 'Status: ' || status || chr(10) || 'Equivalent: ' || equivalent
  || printf(chr(10) || 'Confidence: %.2f', confidence) || chr(10) || 'Explanation: ' || CASE WHEN status = 'error' THEN condition WHEN equivalent THEN 'results are identical'
  WHEN n_different IS NULL THEN 'results have different columns' ELSE 'results differ' END
  || chr(10) || 'Gold:' || chr(10) || gold || chr(10) || 'Generated:' || chr(10) || made FROM ({_CASES}) JOIN ({_TEXTS}) USING (case_no)""")
def sql_eval_report(t):
    return compare.sql_pair_report(case_results(t))


# SQL over tables

_SQL_CASES = {
    "sql_case_revenue_by_nation": """
SELECT n_name, r_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name""",
    "sql_case_top_customers": """
SELECT c_custkey, c_name, round(sum(o_totalprice), 2) AS spent FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name ORDER BY spent DESC, c_custkey LIMIT 20""",
    "sql_case_order_rank": """
SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS order_rank FROM orders""",
}


def _sql_case(name, sql):
    @query(name, sql)
    def run(t):
        register_tables(t)
        return tables.execute_query(t.spark, sql)


for _name, _sql in _SQL_CASES.items():
    _sql_case(_name, _sql)


# Catalog

_TYPES = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
                 "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
                 "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
}
_PROFILE = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {no} AS column_no, '{ty}' AS data_type, "
    + ("CAST(max(NULL) AS VARCHAR)" if ty.startswith("array") else f"CAST(min({c}){' + 0.0' if ty == 'double' else ''} AS VARCHAR)") + f" AS sample_value FROM {t}"
    for t, columns in _TYPES.items() for no, (c, ty) in enumerate(columns.items(), 1)
)


def profile(t):
    return catalog.schema_profile({n: getattr(t, n) for n in _TYPES})


@query("schema_profile", _PROFILE)
def schema_profile(t):
    return profile(t)


@query("schema_profile_footers", _PROFILE)
def schema_profile_footers(t):
    """The same profile; columns whose least value stands in the files' footers are not read."""
    return catalog.footer_profile(t.spark, {n: f"{t.folder}/{n}.parquet" for n in _TYPES})


@query("schema_text", f"""
SELECT table_name, string_agg(column_name || ' ' || data_type || coalesce(' e.g. ' || sample_value, ''), ', ' ORDER BY column_no) AS columns_text
FROM ({_PROFILE}) GROUP BY table_name""")
def schema_text(t):
    return catalog.schema_text(profile(t))


@query("column_tables", f"""
SELECT upper(column_name) AS column_name, string_agg(DISTINCT upper(table_name), ',' ORDER BY upper(table_name)) AS table_names
FROM ({_PROFILE.replace("'n_regionkey'", "'n_nationkey'").replace("'c_nationkey'", "'n_nationkey'")}) GROUP BY 1""")
def column_tables(t):
    """Key columns get one name, so that some columns occur in several tables."""
    same = profile(t).replace({"n_regionkey": "n_nationkey", "c_nationkey": "n_nationkey"}, subset=["column_name"])
    return catalog.column_tables(same)


@query("unknown_columns", """
SELECT c_custkey, 'ORDERS' AS table_name, 'C_MKTSEGMENT' AS column_name, c_mktsegment AS literal,
       CASE WHEN c_acctbal > 0 THEN 'O_ORDERPRIORITY' END AS suggested_column FROM customer WHERE c_nationkey < 10
UNION ALL SELECT c_custkey, 'CUSTOMER', 'O_ORDERPRIORITY', '1-' || lower(c_mktsegment), NULL FROM customer WHERE c_nationkey >= 10 AND c_acctbal > 0""")
def unknown_columns(t):
    """A query text per customer; the segment is a column of customer, not of orders."""
    sql = F.concat(
        F.lit("SELECT 1 FROM "), F.when(F.col("c_nationkey") < 10, "orders").otherwise("customer"),
        F.lit(" WHERE c_mktsegment = '"), F.col("c_mktsegment"), F.lit("'"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit(" AND o_orderpriority = '1-"), F.lower("c_mktsegment"), F.lit("'"))).otherwise(""),
    )
    columns = {name: getattr(t, name).columns for name in _TYPES}
    return catalog.unknown_columns(t.customer.select("c_custkey", sql.alias("sql")), columns, "c_custkey", "sql")


@query("unknown_columns_in_scope", """
SELECT n_nationkey, 'NATION' AS table_name, CASE n_nationkey % 5 WHEN 3 THEN 'R_NAME' ELSE 'C_NAME' END AS column_name, n_name AS literal,
       CASE WHEN n_nationkey % 5 = 3 THEN 'R_NAME' END AS suggested_column FROM nation WHERE n_nationkey % 5 >= 3""")
def unknown_columns_in_scope(t):
    """A query text per nation: a comma join, a common table expression, words in a literal, a column behind the wrong alias, and one behind a comment."""
    name, kind = F.col("n_name"), F.col("n_nationkey") % 5
    sql = (
        F.when(kind == 0, F.format_string("SELECT 1 FROM nation, region WHERE n_regionkey = r_regionkey AND r_name = '%s'", name))
        .when(kind == 1, F.format_string("WITH x AS (SELECT n_name AS name FROM nation) SELECT * FROM x WHERE name = '%s'", name))
        .when(kind == 2, F.format_string("SELECT 1 FROM nation WHERE n_name = 'from region where r_name = ''%s'''", name))
        .when(kind == 3, F.format_string("SELECT 1 FROM nation n JOIN region r ON n_regionkey = r_regionkey WHERE n.r_name = '%s' AND r.r_name = '%s'", name, name))
        .otherwise(F.format_string("SELECT 1 FROM nation -- , customer\nWHERE c_name = '%s'", name))
    )
    columns = {table: getattr(t, table).columns for table in _TYPES}
    return catalog.unknown_columns(t.nation.select("n_nationkey", sql.alias("sql")), columns, "n_nationkey", "sql")


_MONTHS = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m')
  WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y%m') ELSE o_orderpriority END AS mixed,
  strftime(o_orderdate, '%Y-%m') AS month FROM orders"""


def months(t):
    dash, plain = F.date_format("o_orderdate", "yyyy-MM"), F.date_format("o_orderdate", "yyyyMM")
    mixed = F.when(F.col("o_orderstatus") == "F", dash).when(F.col("o_orderstatus") == "O", plain).otherwise(F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", mixed.alias("mixed"), dash.alias("month"))


@query("yyyymm_profile", f"""
SELECT 'mixed' AS column_name, count(mixed) AS n_values, CAST(count_if(regexp_full_match(mixed, '\\d{{4}}-\\d{{2}}|\\d{{6}}')) AS BIGINT) AS n_month,
       round(count_if(regexp_full_match(mixed, '\\d{{4}}-\\d{{2}}|\\d{{6}}')) / count(mixed), 6) AS month_share FROM ({_MONTHS})
UNION ALL SELECT 'month', count(month), count(month), 1.0 FROM ({_MONTHS})""")
def yyyymm_profile(t):
    return catalog.month_profile(months(t))


@query("yyyymm_normalise", f"""
SELECT o_orderkey, CASE WHEN regexp_full_match(mixed, '\\d{{4}}-\\d{{2}}|\\d{{6}}') THEN month || '-01' END AS first_day FROM ({_MONTHS})""")
def yyyymm_normalise(t):
    return months(t).select("o_orderkey", catalog.month_to_date(F.col("mixed")).cast("string").alias("first_day"))


# Class probabilities: the first four components, made positive and scaled to sum 1.
_RAW = "abs(CAST(embedding[1] AS DOUBLE)) + abs(CAST(embedding[2] AS DOUBLE)) + abs(CAST(embedding[3] AS DOUBLE)) + abs(CAST(embedding[4] AS DOUBLE))"
_PROBS = " UNION ALL ".join(
    f"SELECT vec_id, {i} AS class_id, 'class{i}' AS class_name, round(abs(CAST(embedding[{i + 1}] AS DOUBLE)) / ({_RAW}), 6) AS prob FROM embeddings"
    for i in range(4)
)
_TOPN = f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, class_id) AS INT) AS rank FROM ({_PROBS}) WHERE prob > 0.2) WHERE rank <= 2"""


def probabilities(t):
    parts = [F.abs(F.element_at("embedding", i + 1).cast("double")) for i in range(4)]
    total = parts[0] + parts[1] + parts[2] + parts[3]
    scaled = F.array(*[F.round(p / total, 6) for p in parts])
    rows = t.embeddings.select("vec_id", F.posexplode(scaled).alias("class_id", "prob"))
    return rows.select("vec_id", "class_id", F.concat(F.lit("class"), F.col("class_id")).alias("class_name"), "prob")


@query("classify_topn", _TOPN)
def classify_topn(t):
    return classify.top_classes(probabilities(t), "vec_id", 2, 0.2)


@query("classify_metadata", f"SELECT p.*, n.n_name AS metadata FROM ({_TOPN}) p LEFT JOIN nation n ON n.n_nationkey = p.class_id")
def classify_metadata(t):
    metadata = t.nation.select(F.col("n_nationkey").alias("class_id"), F.col("n_name").alias("metadata"))
    return classify.with_metadata(classify.top_classes(probabilities(t), "vec_id", 2, 0.2), metadata)


@query("binary_predict", f"""
SELECT vec_id, max(prob) FILTER (class_id = 0) AS p_negative, max(prob) FILTER (class_id = 1) AS p_positive,
       CASE WHEN max(prob) FILTER (class_id = 1) > max(prob) FILTER (class_id = 0) THEN 1 ELSE 0 END AS prediction FROM ({_PROBS}) GROUP BY vec_id""")
def binary_predict(t):
    wide = probabilities(t).groupBy("vec_id").agg(
        F.max(F.when(F.col("class_id") == 0, F.col("prob"))).alias("p_negative"),
        F.max(F.when(F.col("class_id") == 1, F.col("prob"))).alias("p_positive"),
    )
    return wide.withColumn("prediction", classify.binary_prediction(F.col("p_negative"), F.col("p_positive")))
