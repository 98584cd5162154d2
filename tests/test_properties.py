"""Expressions against plain Python on generated texts and numbers."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptloom.functions import templates, text
from promptloom.operators import compare, reshape

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
# Characters outside the basic plane count once in both Python and Spark; lone surrogates are not valid text.
texts = st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=30)


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, t string")


def column(df, value):
    return [r[0] for r in df.orderBy("i").select(value).collect()]


@few
@given(texts, st.integers(1, 7))
def test_chunks_join_back(spark, values, size):
    got = column(frame(spark, values), text.chunk_text(F.col("t"), size))
    assert ["".join(c) for c in got] == values
    assert all(len(p) == size for c in got for p in c[:-1])


@few
@given(texts)
def test_ascii_and_budget(spark, values):
    df = frame(spark, values)
    assert column(df, text.ascii_clean(F.col("t"), df.schema["t"].dataType)) == [v.encode("ascii", "ignore").decode() for v in values]
    assert column(df, text.token_budget(F.col("t"), 7)) == [math.ceil(len(v) / 4) + 7 for v in values]


@few
@given(texts)
def test_render_equals_format(spark, values):
    df = frame(spark, values)
    assert column(df, templates.render("<{t}> no {i}, again {t}", df.columns)) == [
        "<{t}> no {i}, again {t}".format(t=v, i=i) for i, v in enumerate(values)]


@few
@given(st.lists(st.lists(st.text("ab ,", max_size=5), max_size=4), min_size=1, max_size=20))
def test_concept_lists(spark, lists):
    df = frame(spark, ["[" + ",".join(parts) + "]" for parts in lists])
    got = reshape.explode_concepts(df, "t").groupBy("i").agg(F.count("*").alias("n")).collect()
    want = {i: len([p for p in ",".join(parts).split(",") if p.strip()]) for i, parts in enumerate(lists)}
    assert {r.i: r.n for r in got} == {i: n for i, n in want.items() if n}


@few
@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=30))
def test_result_diff_is_a_multiset_difference(spark, a, b):
    left, right = (spark.createDataFrame([(v,) for v in x], "k int") for x in (a, b))
    got = {r.k: (r.n_left, r.n_right) for r in compare.result_diff(left, right).collect()}
    assert got == {k: (a.count(k), b.count(k)) for k in set(a) | set(b) if a.count(k) != b.count(k)}
