"""Profiles of tables and checks of SQL text and month strings against them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.functions.sql import code_tokens, equalities, scope

# The two month formats and the length below which a literal gets no suggestion.
YEAR_MONTH = r"^\d{4}-\d{2}$"
YEARMONTH = r"^\d{6}$"
MIN_LITERAL = 3


_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"
# Types whose least value footers hold exactly.
_IN_FOOTERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _least(f: T.StructField) -> Column:
    least = F.min(f"`{f.name}`")
    # 0.0 and -0.0 compare equal, so which of them min returns is open; adding 0.0 settles it.
    return least + 0.0 if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else least


def schema_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, column_no, data_type, sample_value): the sample is the least non-null value.

    One aggregate per table; nested columns have no sample.
    """
    return _union([_profile_of(table, df, {}) for table, df in tables.items()])


def _profile_of(table: str, df: DataFrame, known: Mapping[str, str | None]) -> DataFrame:
    """Profile of a table; columns whose least value is ``known`` are not read."""
    fields = list(df.schema)
    flat = [f for f in fields if f.name not in known and not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]

    def sample(f: T.StructField) -> Column:
        return F.col(f"`{f.name}`") if f in flat else F.lit(known.get(f.name)).cast("string")

    described = F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(no).alias("column_no"),
            F.lit(f.dataType.simpleString()).alias("data_type"), sample(f).alias("sample_value"),
        )
        for no, f in enumerate(fields, start=1)
    ])
    least = df.agg(F.count(F.lit(1)).alias("_rows"), *[_least(f).cast("string").alias(f.name) for f in flat]) if flat or not known else df.sparkSession.range(1)
    return least.select(F.lit(table).alias("table_name"), F.inline(described))


def footer_profile(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``schema_profile`` of stored Parquet tables, given as table name -> path. Reads the footers now, the rest when asked.

    Whole numbers, booleans and dates get their least values from the footers of the files, by Spark's own push-down of aggregates, so none of their
    data is read. Footers cut long strings and know nothing of NaN, so other columns are scanned; so are those of a table with a column that
    has no statistics in one of its files, or only nulls. Only one row per table reaches the driver.
    """
    parts = []
    for table, path in paths.items():
        df = spark.read.parquet(path)
        known = _footer_least(spark, path, [f.name for f in df.schema if isinstance(f.dataType, _IN_FOOTERS)])
        parts.append(_profile_of(table, df, known))
    return _union(parts)


def _pushing_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose Parquet scans answer aggregates from footers; the caller's settings stay as they are."""
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set(_PUSHDOWN, "true")
    return other


def footer_minima(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """One row: the least value of each column, as text, from footers alone."""
    least = _pushing_session(spark).read.parquet(path).agg(*[F.min(f"`{n}`").alias(n) for n in names])
    return least.select([F.col(f"`{n}`").cast("string").alias(n) for n in names])


def _footer_least(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, str | None]:
    if not names:
        return {}
    try:
        return footer_minima(spark, path, names).first().asDict()
    except (PySparkException, Py4JError) as failure:
        # Spark names the setting where a footer lacks what it needs; anything else is a failure.
        if _PUSHDOWN not in str(failure):
            raise
        return {}


def schema_text(profile: DataFrame) -> DataFrame:
    """One line of prompt text per table."""
    columns = F.array_sort(F.collect_list(F.struct(
        "column_no",
        F.concat(F.col("column_name"), F.lit(" "), F.col("data_type"),
                 F.coalesce(F.concat(F.lit(" e.g. "), F.col("sample_value")), F.lit(""))).alias("text"),
    )))
    return profile.groupBy("table_name").agg(
        F.array_join(F.transform(columns, lambda c: c["text"]), ", ").alias("columns_text")
    )


def column_tables(profile: DataFrame) -> DataFrame:
    """Every table that has a column of a given name, joined by commas in name order."""
    return profile.groupBy(F.upper("column_name").alias("column_name")).agg(
        F.array_join(F.array_sort(F.collect_set(F.upper("table_name"))), ",").alias("table_names")
    )


def unknown_columns(df: DataFrame, tables: Mapping[str, Sequence[str]], query_id: str, sql: str) -> DataFrame:
    """Predicates ``column = 'literal'`` on a column that none of the queried tables has, with ``suggested_column``: the first other column of the same
    query that exists and is compared to a value containing the literal.

    Tables are those of FROM lists and joins, anywhere in the query; words in literals and comments are none of them. A column behind a table's name
    or alias is looked for in that table alone, and ``table_name`` is that table, else the first one read. What a query reads from derived tables, table functions or
    common table expressions cannot be told, so there only columns behind the alias of a table are judged. A table that is not known has no columns.

    ``tables`` maps table names to column names. It is schema metadata, known when the plan is made, so it
    becomes a literal map and the check needs neither join nor shuffle.
    """
    columns = F.create_map(*[
        part for name, cols in tables.items() for part in (F.lit(name.upper()), F.array(*[F.lit(c.upper()) for c in cols]))
    ])
    none = F.array().cast("array<string>")
    held = lambda name: F.coalesce(F.try_element_at(columns, name), none)
    rows = df.select(query_id, code_tokens(F.col(sql)).alias("_code")).select(query_id, scope(F.col("_code")).alias("_scope"), equalities(F.col("_code")).alias("_ps"))
    rows = rows.withColumn("_all", F.flatten(F.transform("_scope.tables", lambda t: held(t["name"]))))

    def judged(p: Column) -> Column:
        behind = F.get(F.filter("_scope.tables", lambda t: (t["alias"] == p["qualifier"]) | (t["name"] == p["qualifier"])), F.lit(0))["name"]
        first = F.coalesce(F.get(F.col("_scope.tables"), F.lit(0))["name"], F.lit(""))
        plain = p["qualifier"].isNull()
        return F.struct(
            p["column_name"].alias("column_name"), p["literal"].alias("literal"), F.when(plain, first).otherwise(behind).alias("table_name"),
            F.when(plain & ~F.col("_scope.open"), F.array_contains(F.col("_all"), p["column_name"]))
            .when(~plain & behind.isNotNull(), F.array_contains(held(behind), p["column_name"])).alias("known"),
        )

    rows = rows.select(query_id, F.array_distinct(F.transform("_ps", judged)).alias("_ps"))
    bad = rows.withColumn("_b", F.explode(F.filter("_ps", lambda p: ~p["known"])))
    fitting = F.filter(
        F.col("_ps"),
        lambda p: p["known"] & (F.length(F.col("_b.literal")) >= MIN_LITERAL) & F.contains(F.upper(p["literal"]), F.upper(F.col("_b.literal"))),
    )
    return bad.select(
        query_id, "_b.table_name", "_b.column_name", "_b.literal", F.array_min(F.transform(fitting, lambda p: p["column_name"])).alias("suggested_column"),
    )


def is_month(value: Column) -> Column:
    return value.rlike(YEAR_MONTH) | value.rlike(YEARMONTH)


def month_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per string column over all rows: non-null values, those shaped like a month, and their share."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    counts = df.agg(*[
        F.struct(F.count(n).alias("n_values"), F.count_if(F.coalesce(is_month(F.col(n)), F.lit(False))).alias("n_month")).alias(n)
        for n in names
    ])
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("c")) for n in names])
    return counts.select(F.inline(rows)).select(
        "column_name", "c.n_values", "c.n_month",
        F.when(F.col("c.n_values") > 0, F.round(F.col("c.n_month") / F.col("c.n_values"), 6)).otherwise(0.0).alias("month_share"),
    )


def month_to_date(value: Column) -> Column:
    """First day of a ``YYYY-MM`` or ``YYYYMM`` month; null for anything else."""
    return (
        F.when(value.rlike(YEAR_MONTH), F.try_to_date(F.concat(value, F.lit("-01")), "yyyy-MM-dd"))
        .when(value.rlike(YEARMONTH), F.try_to_date(F.concat(value, F.lit("01")), "yyyyMMdd"))
    )
