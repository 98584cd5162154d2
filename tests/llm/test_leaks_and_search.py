"""Decontamination, lexical search and hard negatives against SQL and brute force."""

import collections
import math
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptloom import storage
from promptloom.llm import decontamination, lexical, negatives, queries
from tests.llm.conftest import TESTDATA

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def folded(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{TESTDATA}/benchmark.parquet")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TESTDATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op11_decontamination", "op12_lexical_search", "op13_hard_negatives"])
def test_sql(spark, db, name):
    df = queries.QUERIES[name](spark, TESTDATA)
    rows = sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    result = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert rows and rows == sorted(tuple(r[columns.index(c)] for c in sorted(columns)) for r in result.fetchall())


def brute_hits(text, items, width):
    words, hit, found = [(m.group(), m.span()) for m in WORD.finditer(folded(text))], set(), set()
    for item, value in items:
        w = WORD.findall(folded(value))
        for i in range(max(1, len(w) - width + 1)) if w else ():
            window = w[i : i + width]
            for j in range(len(words) - len(window) + 1):
                if [x[0] for x in words[j : j + len(window)]] == window:
                    hit.update(range(j, j + len(window)))
                    found.add(item)
    runs = []
    for j in sorted(hit):
        if runs and runs[-1][2] == j - 1:
            runs[-1][1:] = [words[j][1][1], j]
        else:
            runs.append([*words[j][1], j])
    return len(words), len(hit), [(a, b) for a, b, _ in runs], sorted(map(str, found - {None}))


ITEMS = [(1, "Alpha beta, gamma delta"), (2, "beta gamma"), (3, "é-漢字 \U0001f600 x"), (1, "one two one two one"), (4, None), (5, " .,\n"), (None, "lost item here"), (12, "BETA gamma!")]
TEXTS = [
    None, "", " .\n", "alpha BETA gamma-delta epsilon", "x beta\tgamma", "one two one two one two one", "naïve é 漢字 \U0001f600 X end", "the lost ITEM here and beta gamma",
    "alpha beta gamma", "ALPHA beta gamma delta alpha beta gamma", "beta gamma " * 50, "betagamma beta_gamma",
]


@pytest.mark.parametrize("width,most", [(3, 100_000), (3, 4), (2, 5), (10, 100_000)])
def test_hits(spark, width, most):
    docs = spark.createDataFrame(list(enumerate([*TEXTS, *TEXTS])), "n_words long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["_row"].n_words: (r.n_words, r.n_hit, [tuple(h) for h in r.hits], list(r["items"]))
           for r in decontamination.scan(docs, items, keep=("n_words",), width=width, most=most).collect()}
    assert got == {i: brute_hits(t, ITEMS, width) for i, t in enumerate([*TEXTS, *TEXTS])}


def test_questions_and_answers(spark):
    docs = spark.createDataFrame([(1, "what is it"), (2, "it is so"), (3, "it it")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "What is it", "It is so", "mine")], "item_id string, question string, answer string, hits string")
    got = decontamination.scan(docs, items, columns=("question", "answer"))
    assert sorted((r["_row"].doc_id, r.contaminated, list(r["items"])) for r in got.collect()) == [(1, True, ["a"]), (2, True, ["a"]), (3, False, [])]


def test_hits_odd(spark, odd, none, benchmark):
    got = decontamination.scan(odd, benchmark, keep=odd.columns)
    assert got.count() == odd.count() and got.select("_row.*").columns == odd.columns and got.filter("contaminated").count() == 0
    assert decontamination.scan(none, benchmark).count() == 0
    assert decontamination.scan(odd, benchmark.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_hits_of_a_very_long_text(spark):
    text = "alpha beta gamma filler " * 220_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = decontamination.scan(docs, spark.createDataFrame([(1, "gamma filler alpha")], "item_id long, text string"), width=3).first()
    assert len(text) > 5_000_000 and (row.n_words, row.n_hit) == (880_000, 3 * 219_999) and row.hits[0].start == text.index("gamma")


def brute_search(texts, items, k=20):
    words = {d: WORD.findall(folded(t)) for d, t in texts}
    held = {d: w for d, w in words.items() if w}
    n_docs, n_terms = len(held), sum(map(len, held.values()))
    counts = {d: collections.Counter(w) for d, w in held.items()}
    df = collections.Counter(t for c in counts.values() for t in c)
    out = []
    for item, value in items:
        scores = []
        for d, c in counts.items():
            m = 75 + 25 * len(words[d]) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in WORD.findall(folded(value)) if c[t])
            if score > 0:
                scores.append((-score, d))
        out.extend((item, rank, d, -s) for rank, (s, d) in enumerate(sorted(scores)[:k], 1))
    return sorted(out)


def corpus(seed, topics=12, each=25):
    """Texts of topics with words of their own, common words, and copies."""
    random = np.random.default_rng(seed)
    texts = []
    for t in range(topics):
        own = [f"t{t}w{i}" for i in range(40)]
        for _ in range(each):
            w = [*random.choice(own, 30), *random.choice(["the", "of", "and", "in"], 30)]
            texts.append(" ".join(random.permutation(w)))
    texts += [texts[0]] * 40 + [None, "", "the", "the of and in"]
    items = [(t, " ".join([*random.choice([f"t{t}w{i}" for i in range(40)], 6), "the", "of"])) for t in range(topics)]
    return list(enumerate(texts)), [*items, (100, None), (101, ""), (102, "unknown words"), (103, "the the of")]


@pytest.mark.parametrize("k,at_once,record", [(20, 32_768, 2048), (3, 10, 16), (400, 32_768, 7)])
def test_search(spark, monkeypatch, k, at_once, record):
    monkeypatch.setattr(lexical, "TERMS_AT_ONCE", at_once)
    monkeypatch.setattr(lexical, "RECORD", record)
    texts, items = corpus(1)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = lexical.search(docs, spark.createDataFrame(items, "item_id long, text string"), k)
    assert sorted(tuple(r) for r in got.collect()) == brute_search(texts, items, k)


def test_blocks_are_skipped_by_exact_bounds(spark, monkeypatch):
    """With pivots of its own for every topic, most blocks' bounds stay below the threshold, and no bound is below a member's score."""
    seen = {}
    monkeypatch.setattr(lexical, "materialise", lambda df, label="stage": seen.setdefault(label, storage.materialise(df, label)))
    monkeypatch.setattr(lexical, "LEAD", 40)
    monkeypatch.setattr(lexical, "PER_PIVOT", 8)
    monkeypatch.setattr(lexical, "MEMBERS", 4)

    texts, items = corpus(2)
    opened = []
    scored = lexical._scored
    monkeypatch.setattr(lexical, "_scored", lambda shared, k: opened.append(shared.value) or scored(shared, k))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = lexical.search(docs, spark.createDataFrame(items, "item_id long, text string"), 5)
    assert sorted(tuple(r) for r in got.collect()) == brute_search(texts, items, 5)
    asked, records = opened[0], {(c, p): r for b in seen["records"].toArrow().to_batches() for c, p, r in lexical.records_of(b)}
    tested = skipped = 0
    for b in seen["blocks"].collect():
        record = records[b.cell, b.piece]
        wanted = asked.essential[b.term]
        reach = lexical.bounds(asked, wanted, np.array(b.coords, int), np.array(b.maxima, np.int64))
        scores = record.score(asked.dense(wanted), np.array(b.members))
        assert (scores.max(axis=0) <= reach).all()
        tested, skipped = tested + len(wanted), skipped + int((reach < asked.floor[wanted]).sum())
    assert tested and skipped > tested / 4


def test_search_odd(spark, odd, none, benchmark):
    items = spark.createDataFrame([(1, "one mail"), (1, "one"), (None, "naïve w5"), (2, None)], "item_id long, text string")
    got = lexical.search(odd, items).collect()
    mail = [r for r in got if r.item_id == 1]
    assert sorted((r.rank, r.doc_id) for r in mail if r.rank < 3) == [(1, 4), (1, 4), (2, 5), (2, 5)]
    assert [r.doc_id for r in sorted(mail, key=lambda r: r.rank) if r.rank > 2] == [7, 7, None]
    assert {r.doc_id for r in got if r.item_id is None} == {6, 8}
    for docs, asked in ((none, items), (odd, items.limit(0)), (odd.filter("doc_id in (1, 2, 3)"), items)):
        empty = lexical.search(docs, asked)
        assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_search_of_a_very_long_text(spark):
    texts, items = [(1, "common rare " + "common filler " * 360_000), (2, "rare"), (3, "common")], [(1, "rare common")]
    got = lexical.search(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute_search(texts, items) and got.count() == 3


def test_search_among_copies_of_one_text(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'the same words again' as text")
    got = lexical.search(docs, spark.createDataFrame([(1, "same words"), (2, "other")], "item_id long, text string"), 4)
    assert got.count() == 0  # a term of every document weighs nothing
    got = lexical.search(docs.union(docs.selectExpr("doc_id + 10000", "'other'")), spark.createDataFrame([(1, "same words")], "item_id long, text string"), 4)
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [0, 1, 2, 3]


@given(st.integers(1, 200), st.sampled_from([1, 40, 255, 40_000, 2**24, 2**28]), st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_residue_products(width, size, seed):
    random = np.random.default_rng(seed)
    a, b = (random.integers(-size, size + 1, (n, width)) for n in (3, 5))
    largest = max(int((x.astype(object) ** 2).sum(axis=1).max()) for x in (a, b))
    assert (negatives.Product(a, max(largest, 1))(b) == a.astype(object) @ b.astype(object).T).all()


def brute_negatives(rows, percent=80, k=5):
    rows = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if v is not None and y is not None and i is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, (anchor, v, y) in enumerate(rows):
        if anchor % 4 == 0:
            near = sorted((-score(v, w), i) for m, (i, w, z) in enumerate(rows) if m != n and z == y)[:k]
            for ps, positive in near:
                found = sorted((-score(v, w), i) for i, w, z in rows if z != y and percent * -ps <= 100 * score(v, w) <= 100 * -ps)[:k]
                out.extend((anchor, positive, r, i, -ps, -s) for r, (s, i) in enumerate(found, 1))
    return sorted(out)


@pytest.mark.parametrize("anchor_bytes", [16 << 20, 200])
def test_negatives_odd(spark, anchor_bytes):
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in random.integers(-3, 9, 1 + i % 3)], int(random.integers(0, 3))) for i in range(80)]
    rows += [(4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (8, None, 1), (12, [1.0, None], 0), (16, [math.inf], 0), (20, [math.nan], 1), (24, [], 2), (28, [1.0], None), (None, [1.0], 1)]
    df = spark.createDataFrame([(*r, "mine", "mine") for r in rows], "vec_id long, embedding array<float>, label int, slot string, _row string").repartition(3)
    mine = lambda d: negatives.mine(d, F.col("_id") % 4 == 0, anchor_bytes=anchor_bytes)
    assert sorted(tuple(r) for r in mine(df).collect()) == brute_negatives(rows)
    assert mine(df.limit(0)).count() == mine(df.filter("vec_id % 4 = 1")).count() == mine(df.filter("label = 1")).count() == 0
