"""Helpers shared by the operators: held rows, labelled samples, ASCII case folding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java and RE2 agree on these: white space of the contracts, and everything else.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def hold(df: DataFrame, **columns: Column) -> DataFrame:
    """Each row as one struct ``_row`` beside named work columns, so that no column of the caller's can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(n) for n, c in columns.items()])


def release(df: DataFrame, *more: str) -> DataFrame:
    """The rows that ``hold`` took, without (or with some of) the work columns."""
    return df.select("_row.*", *more)


def settle(df: DataFrame) -> DataFrame:
    """The same rows, with their columns computed here. Spark pushes a filter below the columns it reads and unfolds them inside it, once per
    use and inside lambdas once per element; it leaves filters above a condition on a row number."""
    return df.withColumn("_at", F.monotonically_increasing_id()).filter("_at >= 0").drop("_at")


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NOT_SPACE), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, even where a lambda inside refers to it."""
    return F.transform(F.array(value), body)[0]


def sample_by_hash(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """At most ``rows`` rows, the same ones on every run: the first by a hash of ``columns``.

    A cut by another hash leaves about twice as many beforehand, so that the tasks together, however many, send no more than that to the
    driver, which puts them in order.
    """
    share = 2 * rows / max(df.count(), 1)
    if share < 1:
        df = df.filter(F.pmod(F.xxhash64(*columns, F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30)))
    return df.orderBy(F.xxhash64(*columns), *columns).limit(rows)


def label_sample(labels: DataFrame, rows: int, label: str = "quality", doc_id: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled ids as (_id, _label), the same ones on every run: the first by a hash of the id.

    An id labelled twice takes its smaller label. Rows without id or label take no part. The bound makes it fit for a broadcast.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).dropna()
    one = known.groupBy("_id").agg(F.min("_label").alias("_label"))
    return sample_by_hash(one, rows, "_id")


def labelled_rows(docs: DataFrame, labels: DataFrame, rows: int, carry: Sequence[str], doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """The documents of a bounded sample of labels: (_id, _label, and the columns named in ``carry``)."""
    sample = F.broadcast(label_sample(labels, rows, label, doc_id))
    picked = docs.select(F.col(doc_id).alias("_id"), *[F.col(c) for c in carry])
    return picked.join(sample, "_id")
