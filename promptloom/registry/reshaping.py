"""Fan-out, parsing and reshaping of responses."""

from pyspark.sql import functions as F

from promptloom.functions import text as txt
from promptloom.operators import reshape
from promptloom.plans.specs import SPECS
from promptloom.registry.base import prompts, query, text
from promptloom.testing.doubles import json_model


def _q2():
    return F.when(F.col("p_size") % 3 != 0, F.col("p_brand"))


def _q3():
    return F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_type"))


@query("split_response", """
SELECT p_partkey, '' AS prompt, 'q1' AS field, p_name AS response FROM part WHERE p_size <> 7
UNION ALL SELECT p_partkey, '', 'q2', CASE WHEN p_size % 3 <> 0 THEN p_brand END FROM part WHERE p_size <> 7
UNION ALL SELECT p_partkey, '', 'q3', CASE WHEN p_size % 5 = 0 THEN '' ELSE p_type END FROM part WHERE p_size <> 7""")
def split_response(t):
    """Parts of size 7 stand for records without a response."""
    response = F.when(F.col("p_size") != 7, F.struct(F.col("p_name").alias("q1"), _q2().alias("q2"), _q3().alias("q3")))
    return reshape.split_response(t.part.select("p_partkey", F.lit("Ask.").alias("prompt"), response.alias("response")))


@query("concepts_explode", """
SELECT p_partkey, p_name AS concept FROM part UNION ALL SELECT p_partkey, p_brand FROM part
UNION ALL SELECT p_partkey, p_type FROM part""")
def concepts_explode(t):
    listed = F.concat(F.lit("["), F.col("p_name"), F.lit(", "), F.col("p_brand"), F.lit(" ,, "), F.col("p_type"), F.lit(" ,]"))
    return reshape.explode_concepts(t.part.select("p_partkey", listed.alias("concepts_list"))).select("p_partkey", "concept")


@query("question_variants", """
SELECT p_partkey, 'comps' AS kind, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY i) AS INT) AS question_no, question FROM (
  SELECT p_partkey, 1 AS i, p_name AS question FROM part
  UNION ALL SELECT p_partkey, 2, CASE WHEN p_size % 3 <> 0 THEN p_brand END FROM part
  UNION ALL SELECT p_partkey, 3, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_type END FROM part) WHERE question <> ''""")
def question_variants(t):
    rows = t.part.select("p_partkey", F.col("p_name").alias("q1"), _q2().alias("q2"), _q3().alias("q3"))
    return reshape.explode_questions(rows, ["q1", "q2", "q3"], "comps")


@query("unpivot_examples", """
SELECT p_partkey, i AS example_no, e AS example FROM (
  SELECT p_partkey, unnest([1, 2, 3, 4, 5]) AS i,
         unnest([p_name, CASE WHEN p_size % 3 <> 0 THEN p_brand END, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_type END, p_name || '!', p_brand]) AS e
  FROM part) WHERE e <> ''""")
def unpivot_examples(t):
    rows = t.part.select(
        "p_partkey", F.col("p_name").alias("example_1"), _q2().alias("example_2"), _q3().alias("example_3"),
        F.concat(F.col("p_name"), F.lit("!")).alias("example_4"), F.col("p_brand").alias("example_5"),
    )
    return reshape.unpivot_examples(rows, ["p_partkey"])


@query("zip_questions_topics", """
SELECT doc_id, CAST(i AS INT) AS pair_no, a[i + 1] AS question, b[i + 1] AS topic FROM (
  SELECT *, unnest(range(least(len(a), len(b)))) AS i FROM (
    SELECT doc_id, string_split(text, chr(10)) AS a, string_split(text, '. ') AS b FROM documents))""")
def zip_questions_topics(t):
    rows = t.documents.select("doc_id", F.split("text", "\n").alias("question"), F.split("text", r"\. ").alias("topic"))
    return reshape.zip_shortest(rows, "question", "topic", ["doc_id"])


@query("glossary_merge", """
SELECT p_partkey, 'existing' AS origin, 0 AS entry_no, p_brand AS input, 'brand' AS output FROM part
UNION ALL SELECT p_partkey, 'existing', 1, p_type, 'type' FROM part
UNION ALL SELECT p_partkey, 'generated', 0, p_name, 'a part' FROM part
UNION ALL SELECT p_partkey, 'generated', 1, 'size', CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'generated', 2, 'key', CAST(p_partkey AS VARCHAR) FROM part""")
def glossary_merge(t):
    """Half of the responses are fenced objects, half plain lists; stored glossaries come as lines or lists."""
    entries = F.concat(
        F.lit('[{"input": " '), F.col("p_name"), F.lit('", "output": "a part "}, {"input": "size\\n key ", "output": "'),
        F.col("p_size"), F.lit("\\n\\n"), F.col("p_partkey"), F.lit('\\nunused"}]'),
    )
    fenced = F.concat(F.lit('```json\n{"glossary": '), entries, F.lit("}\n```"))
    one = F.concat(F.lit('{"input": "'), F.col("p_brand"), F.lit('", "output": "brand"}'))
    two = F.concat(F.lit('{"input": "'), F.col("p_type"), F.lit('", "output": "type"}'))
    rows = t.part.select(
        "p_partkey", F.when(F.col("p_size") > 25, fenced).otherwise(entries).alias("response"),
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("["), one, F.lit(","), two, F.lit("]")))
        .otherwise(F.concat(one, F.lit("\nnot json\n\n"), two)).alias("input_glossary"),
    )
    return reshape.merge_glossary(rows, ["p_partkey"])


@query("glossary_step", """
SELECT p_partkey, 'existing' AS origin, 0 AS entry_no, 'name' AS input, p_name AS output FROM part
UNION ALL SELECT p_partkey, 'generated', 0, 'size', CAST(p_size AS VARCHAR) FROM part""")
def glossary_step(t):
    """The model's terms join the glossary that was there."""
    rows = t.part.select(
        "p_partkey", F.lit("part(p_name)").alias("schema"), F.col("p_size").cast("string").alias("queries"),
        F.to_json(F.array(F.struct(F.lit("name").alias("input"), F.col("p_name").alias("output")))).alias("input_glossary"))
    model = json_model(glossary=lambda p: '[{"input": " size ", "output": "' + p.split("Queries: ", 1)[1].split("\n", 1)[0] + '"}]')
    return SPECS["glossary"].apply(rows, model, batch_size=64).select("p_partkey", F.inline("glossary_entries"))


@query("strip_fence", """
SELECT p_partkey, 'SELECT ' || p_size || CASE WHEN p_size % 3 = 0 THEN chr(10) || 'FROM part' ELSE '' END AS body FROM part""")
def strip_fence(t):
    size = F.col("p_size").cast("string")
    body = (
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("\n```sql\nSELECT "), size, F.lit("\nFROM part\n```\n")))
        .when(F.col("p_size") % 3 == 1, F.concat(F.lit("```\nSELECT "), size))
        .otherwise(F.concat(F.lit("  SELECT "), size, F.lit(" \n")))
    )
    return t.part.select("p_partkey", txt.strip_fence(body).alias("body"))


@query("extract_sql", """
SELECT p_partkey, CASE p_size % 8
    WHEN 0 THEN 'SELECT ' || p_size || ' FROM part;' WHEN 1 THEN 'with t as (select 1) select ' || p_size || ' from t;'
    WHEN 2 THEN 'SELECT ' || p_size WHEN 3 THEN 'SELECT 1; SELECT ' || p_size || ';' WHEN 4 THEN 'SELECT ''a;' || p_size || ''' AS x'
    WHEN 5 THEN 'select "a;b" from t where x = ''it''''s ' || p_size || ''';' END AS sql FROM part""")
def extract_sql(t):
    size, kind = F.col("p_size").cast("string"), F.col("p_size") % 8
    answer = (
        F.when(kind == 0, F.concat(F.lit("Here you go:\n```sql\nSELECT "), size, F.lit(" FROM part;\n```\nDone.")))
        .when(kind == 1, F.concat(F.lit("The query is with t as (select 1) select "), size, F.lit(" from t; It is short.")))
        .when(kind == 2, F.concat(F.lit("  SELECT "), size, F.lit("  ")))
        .when(kind == 3, F.concat(F.lit("SELECT 1; SELECT "), size, F.lit(";;")))
        .when(kind == 4, F.concat(F.lit("SELECT 'a;"), size, F.lit("' AS x")))
        .when(kind == 5, F.concat(F.lit("That's it: select \"a;b\" from t where x = 'it''s "), size, F.lit("'; isn't it; bye")))
        .when(kind == 6, "I would choose rows with a filter, or select some.")
        .otherwise("I cannot answer that.")
    )
    return t.part.select("p_partkey", txt.extract_sql(answer).alias("sql"))


@query("terminate_sql", "SELECT p_partkey, 'SELECT ' || p_size || ';' AS sql FROM part")
def terminate_sql(t):
    end = F.when(F.col("p_size") % 2 == 0, " ;\n ").otherwise(" \n")
    sql = F.regexp_replace(F.concat(F.lit("\t SELECT "), F.col("p_size"), end), " ;", ";")
    return t.part.select("p_partkey", txt.terminate_sql(sql).alias("sql"))


@query("record_to_text", """
SELECT doc_id AS prompt_id,
       'Lang: ' || lang || chr(10) || 'Source_Name: ' || source || chr(10) || 'N_Chars: ' || n_chars || chr(10) AS all_text,
       'N_Chars: ' || n_chars || chr(10) || 'Lang: ' || lang || chr(10) AS some_text FROM documents""")
def record_to_text(t):
    rows = prompts(t).select(
        "prompt_id", F.struct("lang", F.col("source").alias("source_name")).alias("review_input"), F.struct("n_chars").alias("review_output")
    )
    some = {"review_output": ["n_chars", "absent"], "review_input": ["lang"]}
    return rows.select("prompt_id", reshape.record_text(rows).alias("all_text"), reshape.record_text(rows, some).alias("some_text"))


# Failed SQL: one failed pattern variation, one failed sub-question and one valid structural variation per error event.
FAILED_SQL = """
SELECT event_id, 'pattern_variations' AS origin, 'Q' || event_id AS question, 'SELECT ' || user_id AS generated_sql,
       'syntax error near ' || user_id AS error_message, '' AS error_explanation FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id, 'sub_questions', 'S' || event_id, 'WITH t AS (SELECT 1) SELECT ' || user_id, 'column x does not exist', 'bad column'
FROM events WHERE event_type = 'error'"""

_VARIATION = (
    "array<struct<question: string, sub_question: string, generated_sql: string, original_sql: string, "
    "validation: struct<is_valid: boolean, error: string, explanation: string>, "
    "final_validation: struct<is_valid: boolean, error: string, explanation: string>>>"
)


def nested_results(t):
    no = F.col("event_id").cast("string")
    none = text(None)
    no_verdict = F.lit(None).cast("struct<is_valid: boolean, error: string, explanation: string>")

    def verdict(ok, error, explanation):
        return F.struct(F.lit(ok).alias("is_valid"), error.alias("error"), explanation.alias("explanation"))

    def variation(*parts):
        return F.array(F.struct(*parts)).cast(_VARIATION)

    user = F.col("user_id").cast("string")
    return t.events.filter("event_type = 'error'").select(
        "event_id",
        variation(F.concat(F.lit("Q"), no), none, F.concat(F.lit("SELECT "), user), none,
                  verdict(False, F.concat(F.lit("syntax error near "), user), none), no_verdict).alias("pattern_variations"),
        variation(F.lit("fine"), none, F.lit("SELECT 1"), none, verdict(True, none, none), no_verdict).alias("structural_variations"),
        variation(none, F.concat(F.lit("S"), no), none, F.concat(F.lit("WITH t AS (SELECT 1) SELECT "), user), no_verdict,
                  verdict(False, F.lit("column x does not exist"), F.lit("bad column"))).alias("sub_questions"),
    )


def failed_sql(t):
    return reshape.failed_variations(nested_results(t), ["pattern_variations", "structural_variations", "sub_questions"], ["event_id"])


@query("failed_queries", FAILED_SQL)
def failed_queries(t):
    return failed_sql(t)
