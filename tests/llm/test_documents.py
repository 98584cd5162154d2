"""Near duplicates, quality, tokens, packing and search against brute force."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from promptloom.llm import components, cotraining, minhash, packing, quality_rules, queries, sentencepieces, token_counts, topk
from promptloom.llm.tokens import default_path
from tests.llm.conftest import CLASHES, TESTDATA, texts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TESTDATA}/{t}.parquet'")
    return con


def brute_components(texts, width=4, percent=80):
    sets = {}
    for k, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in texts}


def family(seed, copies, words=60, change=5):
    """A text and copies of it with some words replaced, so that only some pairs reach the threshold."""
    random = np.random.default_rng(seed)
    base = [f"w{x}" for x in random.integers(0, 10**6, words)]
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for i in random.integers(0, words, random.integers(0, change)):
            w[i] = f"v{random.integers(0, 10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_of_families(spark):
    texts = dict(enumerate([*family(1, 60), *family(2, 25, change=3), *family(3, 3), "a b", "A  b", "a b c", "", None, "x"]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    want = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == want
    assert {r.doc_id for r in minhash.near_duplicates(df, pivot_rounds=0).collect() if r.kept} == {k for k, v in want.items() if v[1] == k}


def test_near_duplicates_odd(spark, odd, none):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()]
    assert sorted(got, key=repr)[:0] == [] and minhash.near_duplicates(none).count() == 0
    assert got.count((7, 1, 7, True)) == 2 and (None, 1, None, True) in got and (5, 1, 4, False) in got and (1, 0, 1, True) in got
    assert minhash.keep_first(odd).columns == odd.columns and minhash.keep_first(odd).count() == odd.count() - 2


@pytest.mark.parametrize("name", ["op4_minhash_near_dedup", "op8_exact_topk"])
def test_sql(spark, db, name):
    df = queries.QUERIES[name](spark, TESTDATA)
    rows = sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    result = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert rows == sorted(tuple(r[columns.index(c)] for c in sorted(columns)) for r in result.fetchall())


def test_connected(spark):
    random = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, int(x)) for x in random.integers(200, 400, 80)] + [(5, 5), (500, 501)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[k] == 100 for k in range(101, 161)) and all(r == 7 for k, r in got.items() if 200 <= k < 400) and got[501] == 500 and 5 not in got


def test_quality_statistics(spark, documents, odd):
    texts = texts_of(documents)
    texts |= {10**6 + i: t for i, t in enumerate([None, "", "a b c a b c", "a b c a b a b c\n\na b\na b\n \n \n", "x " * 300, "é#*$ $ a\n" * 3])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = quality_rules.with_statistics(df, "text").collect()
    for r in rows:
        t = r.text or ""
        w = WORD.findall(t)
        counts = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {j for i in range(len(w) - 2) if counts[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_quality_rules(spark, documents, labels, odd, none):
    rules = quality_rules.judge(documents, labels)
    joined = rules.select("_row.doc_id", "kept", "base_failed").join(labels, "doc_id")
    good = joined.filter("quality = 1 and not base_failed")
    assert good.filter("not kept").count() <= 0.01 * good.count()
    assert quality_rules.judge(odd, labels.limit(0)).filter("kept").count() == 0 and quality_rules.judge(none, labels).count() == 0
    kept = quality_rules.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() == 0


def test_learned_list(spark):
    random = np.random.default_rng(1)
    rows = [(i, int(not (a > 0.8 and b < 0.3 or c > 0.95)), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(random.random((3000, 3)))]
    df = spark.createDataFrame(rows, "_id long, _label int, a double, b double, c double")
    rules = quality_rules.learn(df, ("a", "b", "c"), cuts=32)
    judged = df.withColumn("rule", quality_rules.verdict(rules))
    wrong = judged.filter((F.col("rule") > 0) != (F.col("_label") == 0)).count()
    assert 2 <= len(rules) <= 8 and wrong < 90
    assert quality_rules.learn(df.filter("_label = 1"), ("a",)) == [] and quality_rules.learn(df.limit(0), ("a",)) == []


def test_cotraining(spark, odd, none):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = cotraining.judge(documents, labels.filter("doc_id % 2 = 0")).select("_row.doc_id", "kept", "score").join(labels.filter("doc_id % 2 = 1"), "doc_id")
    right = judged.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right >= 0.9
    assert cotraining.judge(odd, labels.limit(0)).filter("kept").count() == odd.count() and cotraining.judge(none, labels).count() == 0
    assert cotraining.keep_good(odd, labels).columns == odd.columns


def test_pseudo_labels_help():
    random = np.random.default_rng(2)
    y = random.random(4000) < 0.5
    views = [y[:, None] * 2.0 + random.normal(size=(4000, 3)) for _ in range(2)]
    few, pool, rest = np.arange(4000) < 40, (np.arange(4000) >= 40) & (np.arange(4000) < 2000), np.arange(4000) >= 2000

    def surest(fitted, taken):
        named = []
        for teacher, view in enumerate(fitted):
            z = view.calibrated(views[teacher])
            fresh = [k for k in np.argsort(-np.abs(z), kind="stable") if pool[k] and abs(z[k]) > 2.2 and k not in taken[1 - teacher]][:300]
            named.append((fresh, views[1 - teacher][fresh], (z[fresh] > 0).astype(float)))
        return named

    fitted, weights = cotraining.train([v[few] for v in views], y[few], np.arange(40) % 3 == 0, surest, 4)
    total = weights[0] + sum(w * f.calibrated(v[rest]) for w, f, v in zip(weights[1:], fitted, views))
    assert ((total > 0) == y[rest]).mean() > 0.93


def test_the_whole_pool_is_searched_for_the_surest(spark):
    """The surest rows of either label, from all rows; known ones and unsure ones are left out, and equal sureness is shared out by hash."""
    n = 5_000
    cells = [F.lit(0.0).alias(c) for c in cotraining.SEEN[1:-2]]
    seen = spark.range(n).select((F.col("id") / 100.0 - 25).alias("_c0"), *cells, F.lit(1).alias("_source_at"), F.lit(2).alias("_lang_at"), F.col("id").alias("_h"))
    w = lambda size, first: cotraining.View(np.r_[0.0, first, np.zeros(size - 1)], np.zeros(size), np.r_[8.0, np.ones(size - 1)])
    content, blank = w(len(cotraining.CONTENT), 8.0), w(1 + 2 * cotraining.BUCKETS, 0.0)
    first, second = cotraining._surest(seen, [content, blank], [set(), set()], 100, 0.95)
    assert 40 <= sum(first[2] == 1) <= 60 and 40 <= sum(first[2] == 0) <= 60 and second[0] == []
    assert min(k for k, good in zip(first[0], first[2]) if good) >= 4_930 and max(k for k, good in zip(first[0], first[2]) if not good) <= 70
    assert first[1].shape == (len(first[0]), 1 + 2 * cotraining.BUCKETS) and (first[1].sum(axis=1) == 2).all()
    again, _ = cotraining._surest(seen, [content, blank], [set(), set(first[0])], 100, 0.95)
    assert again[0] and not set(again[0]) & set(first[0])
    every, _ = cotraining._surest(seen, [content, blank], [set(), set()], 10**6, 0.95)
    assert sorted(every[0]) == [k for k in range(n) if abs(k / 100 - 25) >= np.log(19)]
    assert cotraining._surest(seen.limit(0), [content, blank], [set(), set()], 100, 0.95)[0][0] == []


def test_an_id_of_many_rows_is_one_labelled_document(spark, documents, labels):
    many = documents.join(labels, "doc_id").select(documents.columns).limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3_000)))).drop("copy")
    once = cotraining._fit(*_fit_inputs(documents, labels), 10_000, 1, 100, 0.95)
    twice = cotraining._fit(*_fit_inputs(documents.union(many), labels), 10_000, 1, 100, 0.95)
    assert np.allclose(once[1], twice[1]) and all(np.allclose(a.weights, b.weights) for a, b in zip(once[0], twice[0]))


def _fit_inputs(documents, labels):
    docs = documents.select(*[F.col(a).alias(b) for a, b in
                              (("doc_id", "_id"), ("text", "_text"), ("source", "_source"), ("lang", "_lang"), ("n_chars", "_n_chars"))])
    return docs, labels.select(F.col("doc_id").alias("_key"), F.col("quality").alias("_quality"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_path("byte_bpe_50k.json"))


def test_packing(spark, odd, none, tokenizer):
    texts = dict(enumerate([*texts_of(spark.read.parquet(f"{TESTDATA}/documents.parquet")).values(), None, "", "<|endoftext|> 漢字 x", " " * 999]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    for limits in (packing.Limits(), packing.Limits(64, 6, 40)):
        rows = packing.pack(df, limits=limits, window=64).withColumn("crc", F.crc32("ids")).collect()
        pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            pieces[r.doc_id].append(r)
            sequences[r.sequence_id].append(r)
        for doc, text in texts.items():
            ids, at = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4"), 0
            for r in sorted(pieces[doc], key=lambda r: r.start):
                part = ids[r.start : r.start + r.length].tobytes()
                assert r.start == at and r.doc_tokens == len(ids) and bytes(r.ids) == part and r.crc == zlib.crc32(part)
                at += r.length
            assert at == len(ids)
        for s in sequences.values():
            at = 0
            for r in sorted(s, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            assert at <= limits.tokens and at & (at - 1) == 0 and len(s) <= limits.segments and sum(r.loss_tokens for r in s) <= limits.loss
    assert packing.pack(odd).filter("start = 0").count() == odd.count() and packing.pack(none).count() == 0


def test_token_counts(spark, odd, none, tokenizer):
    texts = texts_of(spark.read.parquet(f"{TESTDATA}/documents.parquet"))
    texts |= {10**6: "a\n\nb", 10**6 + 1: "\n", 10**6 + 2: "漢字\nnaïve\U0001f600\n", 10**6 + 3: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = collections.defaultdict(dict)
    for r in token_counts.count(df).collect():
        got[r.doc_id][r.section] = (r.start, r.stop, r.n_tokens)
    for doc, text in texts.items():
        starts = np.cumsum([0, *[len(x) + 1 for x in text.split("\n")]])
        spans = [(int(a), int(min(b, len(text)))) for a, b in zip(starts, starts[1:]) if a < min(b, len(text))]
        offsets = [o[0] for o in tokenizer.encode(text, add_special_tokens=False).offsets] if text else []
        counts = collections.Counter(int(np.searchsorted([a for a, _ in spans], o, "right")) - 1 for o in offsets)
        assert got[doc] == {k: (a, b, float(counts[k])) for k, (a, b) in enumerate(spans)}
    assert token_counts.count(odd).count() > 0 and token_counts.count(none).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution(rule):
    random = np.random.default_rng(6)
    for _ in range(200):
        ends = np.cumsum(random.integers(1, 6, 8))
        starts = ends - np.diff(ends, prepend=0)
        cuts = np.sort(random.choice(np.arange(ends[-1] + 3), 6, replace=False)).reshape(3, 2)
        tokens, _ = token_counts.attribute(ends, starts, cuts, rule)
        want = np.zeros(4)
        for a, b in zip(starts, ends):
            owners = [next((k for k, (x, y) in enumerate(cuts) if x <= i < y), 3) for i in range(a, b)]
            if rule == "split":
                for o in owners:
                    want[o] += 1 / (b - a)
            else:
                want[{"first": owners[0], "last": owners[-1], "most": max(sorted(set(owners)), key=owners.count)}[rule]] += 1
        assert np.allclose(tokens, want)


def test_given_sections(spark):
    df = spark.createDataFrame([(1, "hello world", [(6, 11)]), (2, "hello", None)], "doc_id long, text string, s array<struct<a:int,b:int>>")
    rows = {(r.doc_id, r.section): r.n_tokens for r in token_counts.count(df, F.col("s"), "most").collect()}
    assert rows == {(1, 0): 1.0, (1, -1): 1.0, (2, -1): 1.0}


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_path("piece_bpe_32k.model"))


def test_sentencepiece_query(spark, documents, library):
    texts = texts_of(documents)
    for r in queries.op2_sentencepiece(spark, TESTDATA).collect():
        assert list(r.ids) == library.encode(texts[r.doc_id]) and r.exact and r.n_ids == len(r.ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abehinrst  \n\té漢ﬁ09.,ABthe\U0001f600"), max_size=50))
def test_sentencepiece_equals_library(text):
    model = sentencepieces.pieces()
    words = sentencepieces.marked_words(text)
    known = dict(model.encode_sorted(sorted(set(words))))
    ids = [i for w in words for i in known[w]]
    assert ids == sentencepiece_library().encode(text) and model.decode(ids) == text


def sentencepiece_library(found=[]):  # noqa: B006
    if not found:
        found.append(sentencepiece.SentencePieceProcessor(model_file=default_path("piece_bpe_32k.model")))
    return found[0]


def test_sentencepiece_odd(spark, odd, none):
    rows = sentencepieces.encode(odd, keep=("doc_id", "kept", "text")).withColumn("back", sentencepieces.decode(F.col("ids"))).collect()
    assert all(r.back == r.text and r.exact == (None if r.text is None else True) for r in rows) and len(rows) == odd.count()
    assert sentencepieces.encode(none).count() == 0


def test_topk(spark):
    random = np.random.default_rng(8)
    vectors = [(i, random.normal(size=24).round(2).tolist()) for i in range(700)]
    vectors += [(700, None), (701, [1.0, None]), (702, [float("nan")] * 24), (None, [1.0] * 24), (703, vectors[50][1]), (50, vectors[50][1]), (704, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("_row", F.lit(1)).withColumn("q", F.lit("x"))
    got = sorted(tuple(r) for r in topk.search(df, F.col("_id") % 50 == 0, k=7, block=64, query_block=4, width=5).collect())
    usable = [(k, [int(np.floor(256 * x)) for x in v]) for k, v in vectors if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for at, (query, v) in enumerate(usable):
        if query % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), k) for j, (k, w) in enumerate(usable) if j != at)[:7]
            want += [(query, rank, k, -s) for rank, (s, k) in enumerate(scores, 1)]
    assert got == sorted(want)
    assert topk.search(df.limit(0), F.col("_id") % 50 == 0).count() == 0
    assert topk.search(df.filter("vec_id in (50, 60)").dropDuplicates(["vec_id"]), F.col("_id") % 50 == 0).count() == 1


def test_clashing_names(odd):
    assert set(CLASHES) <= set(odd.columns)


def test_repeated_ids_are_judged_by_row(spark):
    """One of two equal rows stays; an id with a copy and a text of its own loses the copy only, and links nothing through the id."""
    texts = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcx"}
    near = texts["b"] + " b"
    given = [(3, "x"), (9, "a"), (9, "x"), (7, "c"), (7, "c"), (2, "a"), (9, "b"), (None, "x"), (1, ""), (1, "")]
    df = spark.createDataFrame([(i, texts.get(t, t)) for i, t in given] + [(12, near)], "doc_id long, text string").repartition(3)
    name = {v: k for k, v in texts.items()}
    kept = sorted(((r.doc_id, name.get(r.text, r.text)) for r in minhash.keep_first(df).collect()), key=repr)
    assert kept == sorted([(3, "x"), (7, "c"), (2, "a"), (9, "b"), (None, "x"), (1, ""), (1, "")], key=repr)
    groups = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert groups == {(3, 3), (9, 2), (9, 3), (9, 9), (7, 7), (2, 2), (None, None), (1, 1), (12, 9)}
