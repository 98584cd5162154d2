"""License, secret and personal data scans against plain regular expressions."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptloom.llm import crf, licenses, pii, queries, secrets
from tests.llm.conftest import CLASHES, TESTDATA, texts_of

LOW = str.maketrans(licenses.UPPER, licenses.LOWER)


def license_base(text):
    words = re.findall(licenses.WORD, (text or "").translate(LOW))
    hits = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_license_base(spark, documents):
    texts = texts_of(documents)
    for r in queries.op1_license_scan(spark, TESTDATA).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == license_base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_license_templates(spark, odd, none):
    texts = {
        1: "x y Released under the MIT License.", 2: "the license of the mit was released", 3: "Licensed under the Apache-License, version 2.0 and cc by cc-by",
        4: "PERMISSION is hereby granted, free of charge, to any person obtaining a copy", 5: "granted is permission of charge free",
        6: "This program is free software; you can redistribute it under the terms of the GNU General Public License", 7: None, 8: "",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r._row.doc_id: r for r in licenses.scan(df).collect()}
    assert {k: got[k].labels for k in texts} == {1: "mit", 2: "", 3: "apache-2.0,cc-by", 4: "mit", 5: "", 6: "gpl", 7: "", 8: ""}
    assert got[1].score == 1.0 and 0 < got[4].score < 1 and (got[3].n_base, got[3].first_word, got[3].last_word) == (2, 9, 11)
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(none).count() == 0
    assert set(CLASHES) <= set(licenses.scan(odd).select("_row.*").columns)


def test_license_mentions_and_whole_licences(spark):
    bodies = {10 + n: (t.label, t.text) for n, t in enumerate(licenses.TEMPLATES) if len(t.words) > 50}
    texts = {1: "MIT License", 2: "used under MIT license here", 3: "see the Apache License", 4: "a licence of the MIT", 5: "free of charge", 6: "general license"}
    # Punctuation, case and line breaks do not matter.
    texts |= {k: "Copyright (c) 1999\n\n" + ",\n".join(x.upper().split()) for k, (_, x) in bodies.items()}
    got = {r._row.doc_id: r for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {k: got[k].labels for k in range(1, 7)} == {1: "mit", 2: "mit", 3: "apache-2.0", 4: "", 5: "", 6: ""}
    assert len(bodies) == 4
    for k, (label, body) in bodies.items():
        assert label in got[k].labels.split(",") and got[k].score == 1.0, (k, label, got[k].labels)
        assert (label, 3, 1.0) in [tuple(f) for f in got[k].found]


def test_license_index_ranks_words_that_occur():
    template = licenses.Template("x", "alpha beta gamma delta key phrase", ("key phrase",))
    counts = {"alpha": 50, "beta": 40, "key": 90, "phrase": 95}
    index = licenses.rare_postings(100, counts, [template], rare=2)
    assert index == {"beta": [(0, 1)], "alpha": [(0, 0)], "key": [(0, 4)]}
    assert licenses.needed_votes(index, [template]) == [1]
    assert licenses.rare_postings(100, {"alpha": 1, "beta": 1, "key": 1}, [template]) == {}


def secret_base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN.replace("(?i)(", "((?i:").replace("_?key)", "_?key))", 1), text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def shown(spans, kinds):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def check_secrets(rows, texts):
    for r in rows:
        base = secret_base(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in base) for k in range(3)]
        assert r.base_sha256 == hashlib.sha256(shown(base, secrets.KINDS).encode()).hexdigest()
        assert {x for x in shown(base, secrets.KINDS).split(",") if x} <= {x for x in r.spans.split(",") if x}


def test_secrets(spark, documents):
    check_secrets(queries.op5_secret_scan(spark, TESTDATA).collect(), texts_of(documents))


def test_secret_edges(spark, odd, none):
    key = "q8Zr2LkP0vXw7TnB4sYd"
    texts = {
        1: f"é Token= '{key}' and {key}", 2: "secret=ab token=abcdefg", 3: "secret=token = abcdefgh", 4: "AKIAAKIA" + "0" * 12, 5: "f" * 24 + "g" + "0a" * 11,
        6: "0123456789abcdefghij01 averylongwordwithoutanydigit 2024-01-02-03-04-05-06", 7: None, 8: f"x {key}{key} y", 9: "passwd : \"x_y.z=1\"",
    }
    rows = secrets.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).select("_row.doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()
    check_secrets(rows, texts)
    spans = {r.doc_id: r.spans for r in rows}
    assert spans[1].endswith("entropy:36:56") and spans[8] == "entropy:2:42" and "entropy" not in spans[6] and spans[3] == ""
    assert secrets.scan(odd).count() == odd.count() and secrets.scan(none).count() == 0


@pytest.mark.parametrize("width", [3, 20])
def test_window_entropy(spark, width):
    texts = ["abcabcabcabcabcabcabcabc", "a" * 30, "q8Zr2LkP0vXw7TnB4sYdq8Zr2L", "aab" * 10 + "0123456789xyzuvw"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", secrets.window_entropy(df_col("t"), width).alias("e"))

    def brute(t):
        best = 0.0
        for i in range(len(t) - width + 1):
            counts = np.array([t[i : i + width].count(c) for c in set(t[i : i + width])]) / width
            best = max(best, float(-(counts * np.log2(counts)).sum()))
        return best

    assert all(abs(r.e - brute(r.t)) < 1e-9 for r in df.collect())


def df_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii_base(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    passes = {
        "email": lambda x: True, "ip": lambda x: all(int(p) <= 255 for p in x.split(".")),
        "card": lambda x: 16 <= len(digits(x)) <= 19 and crf.luhn(digits(x)), "phone": lambda x: 8 <= len(digits(x)) <= 15,
    }
    return [(k, m.start(), m.end()) for k, (name, p) in enumerate(PII.items()) for m in re.finditer(p, text) if passes[name](m.group())]


def test_pii_base():
    random = np.random.default_rng(3)
    parts = ["a@b.c", "x_y@d.e-f", "@", ".", " ", "1.2.3.4", "256.1.1.1", "+1 (555) 010-9999", "4111 1111 1111 1111", "4111-1111-1111-1112", "0", "-", "é", "+49", "(", "a"]
    for _ in range(3000):
        text = "".join(random.choice(parts, random.integers(1, 14)))
        assert pii.base_spans(text) == pii_base(text), text


def test_pii_query(spark, documents):
    texts = texts_of(documents)
    for r in queries.op6_pii(spark, TESTDATA).collect():
        base = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii_base(texts[r.doc_id] or "")]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(r.spans.split(","))


def test_field_finds_more(spark):
    random = np.random.default_rng(5)
    number = lambda n: "".join(map(str, random.integers(0, 10, n)))
    rows = [(f"call +1 ({number(3)}) {number(3)}-{number(4)} or write ab{number(2)}@host.example the end {number(3)}",) for _ in range(300)]
    df = spark.createDataFrame(rows, "text string")
    model = pii.fit(pii.weak_labels(df))
    (base, found), = pii.find(model, pii.Kinds(model), ["call (415) 555-0199 or write to us in 300"])
    assert base == [] and found == [(3, 5, 19)]
    assert pii.fit(pii.weak_labels(df.limit(0))) is None


def test_viterbi_is_exact():
    random = np.random.default_rng(9)
    n = len(crf.TAGS)
    model = crf.Model({}, *[np.zeros((0, n))] * 3, random.normal(size=(n, n)))
    lengths = [1, 4, 0, 5, 3]
    scores = random.normal(size=(sum(lengths), n)).astype(np.float32)
    scores[[2, 6], 0] += 60
    got, at = crf.decode(model, scores, np.cumsum(lengths)), 0
    for size in lengths:
        if size:
            value = lambda p: sum(scores[at + i, t] for i, t in enumerate(p)) + sum(model.pairs[a, b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
            assert value(got[at : at + size]) == pytest.approx(max(map(value, itertools.product(range(n), repeat=size))), abs=1e-3)
        at += size


def test_redaction(spark, odd, none):
    out = pii.redact(odd).collect()
    assert len(out) == odd.count() and pii.redact(none).count() == 0 and pii.redact(odd).columns == odd.columns
    assert sorted(r.n_chars for r in out if r.text == "mail [EMAIL] now") == [16, 16, 16]
    assert pii.redacted("abcdef", [(0, 1, 4), (1, 2, 5)]) == "a[EMAIL]f"


def test_secrets_of_a_text_with_very_many_matches(spark):
    """Places stay exact over many runs of matches."""
    keys = [f"{i:024x}" for i in range(4_000)]
    text = "é " + " ".join(keys)
    df = spark.createDataFrame([(1, text), (2, " ".join(keys[:128])), (3, " ".join(keys[:129]))], "doc_id long, text string")
    got = {r["_row"].doc_id: r for r in secrets.scan(df).select("_row", "n_hex", "spans").collect()}
    assert [got[i].n_hex for i in (1, 2, 3)] == [4_000, 128, 129]
    assert got[1].spans == ",".join(f"hex:{2 + 25 * i}:{26 + 25 * i}" for i in range(4_000))
    assert got[3].spans.endswith(f"hex:{25 * 128}:{25 * 128 + 24}")


def test_planted_keys_without_a_name_are_found_by_entropy(spark):
    planted = {"hex": "0F1E2D3C4B5A69788796A5B4", "alnum": "q7RtZ2mXw9KpLs4VbN8d", "base64": "aB3/x+Yz9-Qw_Er7Ty=Ui1Op"}
    rows = [(i, f"see {k} now") for i, k in enumerate(planted.values())] + [(9, "see zzzzzzzzzzzzzzzzzzzzzzzz1 and internationalisation_of_words-2 now")]
    got = {r["_row"].doc_id: r.spans for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(3)] == [f"entropy:4:{4 + len(k)}" for k in planted.values()] and got[9] == ""


def test_personal_data_is_learned_from_texts_of_one_long_line(spark, documents):
    whole = documents.withColumn("text", F.concat(F.translate("text", "\n", " "), F.repeat(F.lit(" filler words"), 200)))
    lines = pii.weak_labels(whole)
    assert lines.agg(F.max(F.char_length("text"))).first()[0] <= 2000 and pii.fit(lines) is not None
    assert lines.filter("size(spans) > 0").count() >= pii.weak_labels(documents).filter("size(spans) > 0").count() / 2
    same = spark.range(500).selectExpr("'call 5551234 now' as text").union(spark.createDataFrame([("a@b.example",), ("7" * 5000,)], "text string"))
    assert sorted(len(r.text) for r in pii.weak_labels(same).collect()) == [11, 16, 1000, 2000]


def test_field_on_held_out_lines(spark, documents):
    """Of planted lines it has not seen, the field finds what the patterns miss, and little else; numbers and codes of the documents stay."""
    model = pii.fit(pii.labelled_table(documents))
    lines = pii.planted_rows(600, seed=77)
    found = list(pii.find(model, pii.Kinds(model), [t for t, _ in lines]))
    want = {(i, s) for i, (_, spans) in enumerate(lines) for s in spans if not any(a < s[2] and s[1] < b for _, a, b in found[i][0])}
    added = {(i, s) for i, (base, spans) in enumerate(found) for s in spans if s not in base}
    print("held out:", len(want), "added:", len(added), "right:", len(want & added))
    assert len(want) > 300 and len(want & added) >= 0.9 * len(want) and len(want & added) >= 0.95 * len(added)
    texts = [t or "" for t in texts_of(documents).values()]
    assert all(base == sorted(spans) for base, spans in ((sorted(b), s) for b, s in pii.find(model, pii.Kinds(model), texts)))


def test_weak_lines_that_the_patterns_do_not_explain_teach_nothing(spark):
    rows = [("call (415) 555-0199 now", [], True), ("write a@b today", [], True)]
    df = spark.createDataFrame(rows, "text string, spans array<struct<kind:int,start:int,stop:int>>, weak boolean")
    assert pii.fit(df) is None and pii.fit(df.drop("weak")) is not None


@pytest.mark.parametrize("size", [0, 1, 127, 128, 129, 300])
def test_apart(spark, size):
    random = np.random.default_rng(size)
    span = lambda a, n: (int(a), 0, int(a + n), "")
    base = sorted(span(a, n) for a, n in zip(random.integers(0, 20 * size + 1, size), random.integers(1, 60, size)))
    candidates = [span(a, n) for a, n in zip(random.integers(0, 20 * size + 50, 400), random.integers(1, 30, 400))]
    df = spark.createDataFrame([(base, candidates)], f"base array<{secrets.SPAN}>, found array<{secrets.SPAN}>")
    (got,), = df.select(secrets.apart(F.col("found"), F.col("base"))).collect()
    assert [tuple(x) for x in got] == [c for c in candidates if not any(b[0] < c[2] and c[0] < b[2] for b in base)]
