"""Prompt projection, batching and text clean-up."""

from pyspark.sql import functions as F

from promptloom.functions import templates as tpl
from promptloom.functions import text as txt
from promptloom.operators import evaluate, positions, records
from promptloom.plans.specs import SPECS
from promptloom.registry.base import prompts, q, query, text

REVIEW = "Language: {lang}\nSource: {source}\nText: {prompt}"


@query("render_prompt", """
SELECT doc_id AS prompt_id,
       'You review texts.' || chr(10) || chr(10) || 'Language: ' || lang || chr(10) || 'Source: ' || source || chr(10) || 'Text: ' || text AS prompt
FROM documents""")
def render_prompt(t):
    p = prompts(t)
    return p.select("prompt_id", tpl.with_role("You review texts.", tpl.render(REVIEW, p.columns)).alias("prompt"))


@query("step_snapshot", """
SELECT doc_id AS prompt_id, lang AS in_lang, source AS in_source, upper(lang) AS out_summary,
       CAST(length(text) AS BIGINT) AS out_n_chars, upper(lang) AS summary, CAST(length(text) AS BIGINT) AS n_chars
FROM documents""")
def step_snapshot(t):
    p = records.snapshot_input(prompts(t), "review", ["lang", "source"])
    p = p.withColumn("response", F.struct(F.upper("lang").alias("summary"), F.length("prompt").cast("long").alias("n_chars")))
    out = records.merge_response(p, "review")
    return out.select(
        "prompt_id", F.col("review_input.lang").alias("in_lang"), F.col("review_input.source").alias("in_source"),
        F.col("review_output.summary").alias("out_summary"), F.col("review_output.n_chars").alias("out_n_chars"),
        "summary", "n_chars",
    )


def _chat_sql(style):
    default = tpl.MISTRAL_SYSTEM_PROMPT if style == "mistral" else tpl.DEFAULT_SYSTEM_PROMPT
    system = f"CASE WHEN role = 'assistant' THEN 'Be brief.' ELSE {q(default)} END"
    return f"replace(replace({q(tpl.CHAT_TEMPLATES[style])}, '{{system}}', {system}), '{{user}}', text) AS {style}"


@query("chat_template", "SELECT conv_id, turn, " + ", ".join(_chat_sql(s) for s in tpl.CHAT_TEMPLATES) + " FROM conversations")
def chat_template(t):
    system = F.when(F.col("role") == "assistant", "Be brief.").when(F.col("role") == "system", "")
    return t.conversations.select(
        "conv_id", "turn", *[tpl.chat_prompt(s, F.col("text"), system).alias(s) for s in tpl.CHAT_TEMPLATES]
    )


@query("sectioned_prompt", """
SELECT doc_id AS prompt_id,
       'Language' || chr(10) || coalesce(nullif(lang, 'en'), '') || chr(10) || 'Text' || chr(10) || text || chr(10) AS prompt
FROM documents""")
def sectioned_prompt(t):
    sections = [("Language", F.nullif(F.col("lang"), F.lit("en"))), ("Text", F.col("prompt"))]
    return prompts(t).select("prompt_id", tpl.sectioned_prompt(sections).alias("prompt"))


@query("expected_columns", """
SELECT p_partkey AS expected_product_id, p_name AS expected_product_name, p_type AS description FROM part""")
def expected_columns(t):
    gold = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("description"))
    return records.rename_expected(gold, ["product_id", "product_name"])


@query("expected_code", """
SELECT n_name AS expected_icd11_code, n_regionkey AS region, 1 AS n_left FROM nation""")
def expected_code(t):
    gold = t.nation.select(F.struct(F.col("n_name").alias("code"), F.col("n_regionkey").alias("region")).alias("entity"))
    moved = records.lift_field(gold, "entity", "code", "expected_icd11_code")
    left = len(moved.schema["entity"].dataType.fields)
    return moved.select("expected_icd11_code", "entity.region", F.lit(left).alias("n_left"))


@query("gold_answer_product", """
SELECT p_partkey, 'Product ID: ' || p_partkey || chr(10) || 'Product Name: ' || p_name || chr(10)
       || CASE WHEN p_type = 'ECONOMY' THEN '' ELSE 'Description: ' || p_type END AS gold FROM part""")
def gold_answer_product(t):
    description = F.when(F.col("p_type") == "ECONOMY", "N/A").otherwise(F.col("p_type"))
    return t.part.select("p_partkey", tpl.product_answer_text(F.col("p_partkey"), F.col("p_name"), description).alias("gold"))


@query("gold_answer_value", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 7 THEN 'Unknown units' || chr(10)
            ELSE 'Value: ' || CAST(l_quantity AS VARCHAR) || ' ' || l_returnflag || chr(10)
                 || CASE WHEN l_linestatus = 'F' THEN '' ELSE 'Answer: ' || l_linestatus || chr(10) END END AS answer
FROM lineitem""")
def gold_answer_value(t):
    units = F.when(F.col("l_linenumber") != 7, F.col("l_returnflag"))
    answer = F.when(F.col("l_linestatus") == "F", "N/A").otherwise(F.col("l_linestatus"))
    return t.lineitem.select("l_orderkey", "l_linenumber", tpl.value_answer_text(F.col("l_quantity"), units, answer).alias("answer"))


@query("gold_answer_code", """
SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'Unknown code' || chr(10)
       ELSE 'ICD11 Code: ' || n_name || chr(10) || 'Answer: ' || n_regionkey || chr(10) END AS answer FROM nation""")
def gold_answer_code(t):
    code = F.when(F.col("n_regionkey") != 0, F.col("n_name"))
    return t.nation.select("n_nationkey", tpl.code_answer_text(code, F.col("n_regionkey").cast("string")).alias("answer"))


def _replaced(template, **values):
    out = q(template)
    for key, value in values.items():
        out = f"replace({out}, '{{{key}}}', {value})"
    return out


@query("judge_prompt", "SELECT p_partkey, " + _replaced(
    tpl.JUDGE_TEMPLATE, rubric="'5 is exact, 1 is wrong.'", question="'Find ' || p_name", gold="p_brand", answer="p_type"
) + " AS prompt FROM part")
def judge_prompt(t):
    question = F.concat(F.lit("Find "), F.col("p_name"))
    return t.part.select("p_partkey", tpl.judge_prompt("5 is exact, 1 is wrong.", question, F.col("p_brand"), F.col("p_type")).alias("prompt"))


@query("mc_answer_norm", f"""
SELECT item_id, {_replaced(tpl.CHOICE_TEMPLATE, question="text")} AS choice_prompt,
       {_replaced(tpl.TRUTHFUL_TEMPLATE, question="text")} AS truthful_prompt,
       CASE WHEN length(text) > 200 THEN '(A)' ELSE '(' || left(text, 1) || ')' END AS answer FROM benchmark""")
def mc_answer_norm(t):
    answer = F.when(F.length("text") <= 200, F.concat(F.lit("  "), F.left("text", F.lit(1)), F.lit(" ")))
    values = {"question": F.col("text")}
    return t.benchmark.select(
        "item_id", tpl.render(tpl.CHOICE_TEMPLATE, values).alias("choice_prompt"),
        tpl.render(tpl.TRUTHFUL_TEMPLATE, values).alias("truthful_prompt"), tpl.choice_answer(answer).alias("answer"),
    )


@query("fill_defaults", """
SELECT p_partkey, 'How many ' || p_name AS question, 'How many ' || p_name AS original_question,
       CASE WHEN p_size > 25 THEN 'SELECT 1' ELSE '' END AS original_sql, '' AS glossary, 'part(p_name)' AS schema FROM part""")
def fill_defaults(t):
    rows = t.part.select(
        "p_partkey", text(None).alias("question"), F.concat(F.lit("How many "), F.col("p_name")).alias("sub_question"),
        F.when(F.col("p_size") > 25, "SELECT 1").alias("original_sql"),
    )
    return tpl.fill_sql_inputs(rows, "part(p_name)").drop("sub_question")


@query("required_fields", """
SELECT p_partkey, p_name AS error_sql, CASE WHEN p_size > 25 THEN p_type ELSE 'Not provided' END AS error_message,
       'Not provided' AS glossary FROM part""")
def required_fields(t):
    rows = t.part.select("p_partkey", F.col("p_name").alias("error_sql"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("error_message"))
    return tpl.require_or_default(rows, ["error_sql"], ["error_message", "glossary"])


@query("ascii_clean", """
SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS text,
       array_to_string(string_split(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'), chr(10)), '|') AS line_text,
       regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS nested, n_chars FROM documents""")
def ascii_clean(t):
    rows = t.documents.select(
        "doc_id", "text", F.split("text", "\n").alias("lines"), F.struct(F.create_map(F.lit("t"), "text").alias("m")).alias("nested"), "n_chars"
    )
    clean = txt.ascii_clean_columns(rows)
    return clean.select("doc_id", "text", F.array_join("lines", "|").alias("line_text"), F.col("nested.m")["t"].alias("nested"), "n_chars")


@query("modify_rows", """
SELECT d.doc_id, l.quality AS response, d.source || '/' || d.lang AS tag
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL""")
def modify_rows(t):
    rows = t.documents.join(t.labels, "doc_id", "left").select("doc_id", "source", "lang", F.col("quality").alias("response"))
    return records.modify_rows(rows, lambda df: df.select("doc_id", "response", F.concat_ws("/", "source", "lang").alias("tag")))


@query("hooks_fanout", """
SELECT doc_id, CAST(line_no AS INT) AS line_no, line, CAST(length(line) AS BIGINT) AS n FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents)
WHERE length(line) > 0""")
def hooks_fanout(t):
    return records.run_hooks(
        t.documents.select("doc_id", "text"),
        lambda df: df.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")),
        lambda df: df.withColumn("n", F.length("line").cast("long")),
        lambda df: df.filter("n > 0"),
    )


@query("lineage", """
SELECT doc_id AS prompt_id, text AS orig_prompt, lang AS orig_lang, line AS prompt FROM (
  SELECT *, unnest(string_split(text, chr(10))) AS line FROM documents)""")
def lineage(t):
    first = records.keep_origin(prompts(t), data=["lang"])
    fanned = first.withColumn("prompt", F.explode(F.split("prompt", "\n"))).withColumn("lang", F.lit("changed"))
    return records.keep_origin(fanned, data=["lang"]).select("prompt_id", "orig_prompt", F.col("orig_data.lang").alias("orig_lang"), "prompt")


@query("token_budget", """
SELECT source, batch, count(*) AS n_prompts, CAST(max(ceil(length(text) / 4.0)) + 100 AS BIGINT) AS max_tokens FROM (
  SELECT *, CAST(floor((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) / 5) AS BIGINT) AS batch FROM documents)
GROUP BY source, batch""")
def token_budget(t):
    return positions.batch_budget(t.documents, 5, "text", ["doc_id"], ["source"], 100)


@query("token_budget_per_prompt", "SELECT doc_id, CAST(ceil(length(text) / 4.0) + 100 AS BIGINT) AS tokens FROM documents")
def token_budget_per_prompt(t):
    return t.documents.select("doc_id", txt.token_budget(F.col("text"), 100).alias("tokens"))


@query("batch_assign", """
SELECT doc_id, source, CAST(floor((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) / 20) AS BIGINT) AS batch FROM documents""")
def batch_assign(t):
    return positions.assign_batches(t.documents.select("doc_id", "source"), 20, ["doc_id"], ["source"])


@query("chunk_documents", """
SELECT doc_id, CAST(i AS INT) AS chunk_no, substring(text, CAST(i * 1024 + 1 AS BIGINT), 1024) AS chunk FROM (
  SELECT doc_id, text, unnest(range(CAST(ceil(length(text) / 1024.0) AS BIGINT))) AS i FROM documents)""")
def chunk_documents(t):
    return txt.chunk_rows(t.documents, "text", ["doc_id"])


@query("dedupe_questions", """
SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents
GROUP BY lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))""")
def dedupe_questions(t):
    """Only digests and ids are shuffled; equal texts are combined before they are."""
    key = F.sha2(txt.question_key(F.col("text")), 256)
    return t.documents.groupBy(key.alias("k")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies")).drop("k")


@query("sql_validity_rules", """
SELECT p_partkey, p_size % 3 <> 0 AS is_valid,
       CASE WHEN p_size % 6 = 0 THEN 'No SQL query provided' WHEN p_size % 3 = 0 THEN 'Empty SQL query' END AS error,
       CASE WHEN p_size % 3 <> 0 THEN 'SELECT ' || p_size || ';' END AS sql FROM part""")
def sql_validity_rules(t):
    sql = (
        F.when(F.col("p_size") % 6 == 0, text(None)).when(F.col("p_size") % 3 == 0, "  \n ")
        .otherwise(F.concat(F.lit(" SELECT "), F.col("p_size"), F.when(F.col("p_size") % 3 == 1, ";\n").otherwise("")))
    )
    return t.part.select("p_partkey", evaluate.sql_validity(sql).alias("v")).select("p_partkey", "v.is_valid", "v.error", "v.sql")


_INPUTS = sorted({key for spec in SPECS.values() for key in spec.inputs})


def _spec_sql(spec):
    head = f"{spec.role}\n\n" if spec.role else ""
    return (
        f"SELECT p_partkey, {q(spec.name)} AS spec, "
        + _replaced(head + spec.instruction, **{k: f"{q(k + ' ')} || p_name" for k in spec.inputs}) + " AS prompt FROM part"
    )


@query("spec_prompts", " UNION ALL ".join(_spec_sql(s) for s in SPECS.values()))
def spec_prompts(t):
    """The prompt of every specification for every record, in one pass over the table."""
    values = {k: F.concat(F.lit(k + " "), F.col("p_name")) for k in _INPUTS}
    made = F.array(*[
        F.struct(F.lit(s.name).alias("spec"), s.prompt(values).alias("prompt")) for s in SPECS.values()
    ])
    return t.part.select("p_partkey", F.inline(made))
