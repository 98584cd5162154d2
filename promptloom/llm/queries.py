"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptloom.llm import (
    cotraining, decontamination, lexical, licenses, minhash, negatives, packing, pii, quality_rules, secrets, sentencepieces, token_counts, topk,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics, base rules and the learned decision list over all documents."""
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and templates in all documents."""
    return licenses.scan(table(spark, folder, "documents")).select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents."""
    return secrets.scan(table(spark, folder, "documents")).select(
        F.col("_row.doc_id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of all documents, and whether they decode to the text."""
    encoded = sentencepieces.encode(table(spark, folder, "documents"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "exact")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return packing.pack(table(spark, folder, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents."""
    found = pii.scan(table(spark, folder, "documents"))
    name = F.array(*map(F.lit, pii.KINDS))
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"], x["stop"])), ",")
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *[number(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
                        F.sha2(shown("base"), 256).alias("base_sha256"), shown("found").alias("spans"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated scores of both views and their combination for all documents."""
    judged = cotraining.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(F.col("_row.doc_id").alias("doc_id"), "content_score", "metadata_score", "score", "kept")


def op8_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best of all vectors for every fiftieth."""
    return topk.search(table(spark, folder, "embeddings"), F.col("_id") % 50 == 0)


ORACLES["op8_exact_topk"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of all documents."""
    return token_counts.count(table(spark, folder, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near-duplicate documents over 4-word shingles."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


# Shingles, links by counting common ones, and the smallest id reachable by following links.
ORACLES["op4_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] FOR i IN range(1, len(w) - 2)] END) AS g
  FROM w
), n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY ALL),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id AS u, doc_id AS c FROM n UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.u WHERE r.c < l.v)
SELECT n.doc_id, n.n AS n_shingles, c.c AS component_id, n.doc_id = c.c AS kept
FROM n JOIN (SELECT u, min(c) AS c FROM r GROUP BY u) c ON c.u = n.doc_id
"""



def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents inside windows of ten words of the benchmark."""
    found = decontamination.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES["op11_decontamination"] = rf"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), 10) AS k, unnest([array_to_string(w[i:i+9], ' ') FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS g FROM b WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
k AS (SELECT DISTINCT k FROM g),
x AS (SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i, unnest([array_to_string(w[i:i+k-1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS g FROM d, k WHERE len(w) >= k),
h AS (SELECT x.r, x.i, g.k, g.item FROM x JOIN g ON x.g = g.g AND x.k = g.k),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op12_lexical_search"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT row, item_id, term, count(*) AS times FROM (SELECT row, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS row, item_id, {_WORDS} AS w FROM benchmark)) GROUP BY ALL),
f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
i AS (SELECT term, CAST(floor(1000 * ln((2 * CAST(n_docs AS DOUBLE) + 2) / (2 * CAST(df AS DOUBLE) + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
s AS (SELECT q.row, q.item_id, f.r, f.doc_id, CAST(sum(q.times * i.weight * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * f.n * c.n_docs) // c.n_terms)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN i USING (term), c GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector and its positives."""
    return negatives.mine(table(spark, folder, "embeddings"), F.col("_id") % 100 == 0,
                          relabel=lambda name, label: F.when(name % 7 == 0, (label + 1) % 10).otherwise(label))


ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.e, c.e)]) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
) WHERE rank <= 5
"""


for _query in (
    op1_license_scan, op2_sentencepiece, op3_packing, op4_minhash_near_dedup, op5_secret_scan, op6_pii, op7_quality_classifier, op8_exact_topk, op9_quality_rules, op10_token_counts,
    op11_decontamination, op12_lexical_search, op13_hard_negatives,
):
    QUERIES[_query.__name__] = _query
