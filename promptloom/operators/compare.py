"""Comparing result sets and scoring pairs of SQL queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.operators.positions import number_rows
from promptloom.storage import materialise

CASE_SCHEMA = (
    "case_no int, question string, gold_query string, generated_query string, status string, "
    "equivalent boolean, confidence double, explanation string, n_different long"
)

ROWS_PER_CHUNK = 50
CASES_AT_ONCE = 4
FAILURES = (PySparkException, Py4JJavaError)
Judge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class SqlCase:
    question: str
    gold_query: str
    generated_query: str


def _comparable(df: DataFrame, digits: int | None) -> DataFrame:
    """Columns by position, as results may repeat a name; floats rounded by option, and whole-number types made one type."""
    df = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    out = []
    for f in df.schema:
        value = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            value = value.cast("double")
            # Adding 0.0 turns -0.0 into 0.0.
            value = F.round(value, digits) + 0.0 if digits is not None else value
        elif isinstance(f.dataType, T.IntegralType):
            value = value.cast("long")
        out.append(value.alias(f.name))
    return df.select(*out)


def _distinct_names(names: Sequence[str], taken: Sequence[str] = ()) -> list[str]:
    """The names, numbered from their second occurrence on: a, b, a_2."""
    out: list[str] = []
    for name in names:
        n, new = 1, name
        while new.lower() in {x.lower() for x in (*out, *taken)}:
            n, new = n + 1, f"{name}_{n + 1}"
        out.append(new)
    return out


def fingerprint(df: DataFrame, digits: int | None = 6) -> DataFrame:
    """One row (n, h1, h2) that does not depend on the order of rows: their number and the sums of two 64-bit hashes of each, as compared here."""
    rows = _comparable(df, digits)
    # Maps have no hash of their own.
    values = [F.to_json(F.col(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in rows.schema]
    total = lambda *v: F.coalesce(F.sum(F.xxhash64(*v).cast("decimal(20,0)")).cast("string"), F.lit("0"))
    return rows.agg(F.count(F.lit(1)).alias("n"), total(*values).alias("h1"), total(F.lit(1), *values).alias("h2"))


def same_shape(a: DataFrame, b: DataFrame) -> bool:
    """Equal column names, ignoring case, and comparable types, in order."""
    names = [[c.lower() for c in x.columns] for x in (a, b)]
    types = [[f.dataType for f in _comparable(x, None).schema] for x in (a, b)]
    return names[0] == names[1] and types[0] == types[1]


def result_diff(a: DataFrame, b: DataFrame, digits: int | None = 6, order_by: Sequence[str] = ()) -> DataFrame:
    """Rows whose number of occurrences differs: the columns of ``a`` plus ``n_left`` and ``n_right``. A name that comes again is numbered.

    Multisets by default; with ``order_by`` the position in that order counts too. One union and one
    aggregation, so equal rows meet after map-side counting whatever their frequency.
    """
    if len(a.columns) != len(b.columns):
        raise ValueError(f"results have {len(a.columns)} and {len(b.columns)} columns")
    names = list(a.columns)
    if order_by:
        a, b = (number_rows(x, order_by, name="position") for x in (a, b))
        names.append("position")
    left, right = _comparable(a, digits), _comparable(b, digits)
    both = left.withColumns({"_l": F.lit(1), "_r": F.lit(0)}).union(right.withColumns({"_l": F.lit(0), "_r": F.lit(1)}))
    counts = both.groupBy(*left.columns).agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
    differing = counts.filter("n_left <> n_right")
    return differing.select(*[F.col(c).alias(n) for c, n in zip(left.columns, _distinct_names(names, ("n_left", "n_right")))], "n_left", "n_right")


def results_equal(a: DataFrame, b: DataFrame, digits: int | None = 6, order_by: Sequence[str] = ()) -> bool:
    return same_shape(a, b) and result_diff(a, b, digits, order_by).isEmpty()


def evaluate_sql_pairs(spark: SparkSession, cases: Sequence[SqlCase], digits: int | None = 6,
                       judge: Judge | None = None) -> DataFrame:
    """Run each gold/generated pair on the session's tables and compare their whole results.

    The list of cases is the caller's; per case only its fingerprints and a count reach the driver. Fingerprints of all cases are one job, and only
    results whose fingerprints differ are compared row by row. A query that does not
    run, or is a command, gives status ``error`` and confidence 0. Results that differ have confidence 0.5, unless ``judge`` is
    given: it takes (case_no, chunk_no, question, gold_query, generated_query, gold_result, generated_result) and adds
    equivalent, confidence, explanation and differences. The result texts are rows that only one side has, all of them, in
    chunks of ``ROWS_PER_CHUNK`` of each side; a case is equivalent if every chunk is, as confident as its least confident chunk, explained
    by its first deciding chunk, and keeps the differences of all. Results whose columns differ are judged too.
    """
    frames, failures = {}, {}
    for no, case in enumerate(cases, start=1):
        try:
            frames[no] = tuple(spark.sql(_only_query(q)) for q in (case.gold_query, case.generated_query))
        except FAILURES as failure:
            failures[no] = failure
    alike = {no for no, (gold, made) in frames.items() if same_shape(gold, made)}
    # A query that several cases share runs once.
    texts = {no: (_bare(cases[no - 1].gold_query), _bare(cases[no - 1].generated_query)) for no in alike}
    prints, broken = _together({texts[no][side]: fingerprint(frames[no][side], digits) for no in alike for side in (0, 1)})
    failures |= {no: broken[t] for no in alike for t in texts[no] if t in broken}
    equal = {no for no in alike if no not in failures and prints[texts[no][0]] == prints[texts[no][1]]}
    unequal = [no for no in frames if no not in equal and no not in failures]
    totals, open_cases = {}, []
    if judge is None:
        found, broken = _together({no: result_diff(*frames[no], digits).agg(F.count(F.lit(1)).alias("n")) for no in unequal if no in alike})
        totals, failures = {no: n for no, (n,) in found.items()}, failures | broken
    else:
        with ThreadPoolExecutor(CASES_AT_ONCE) as pool:
            lines = {no: pool.submit(lambda no: materialise(_differing_lines(*frames[no], digits), "difference"), no) for no in unequal}
        for no, future in lines.items():
            try:
                total, only_gold = future.result().agg(F.count("*"), F.count_if(F.col("n_left") > F.col("n_right"))).first()
            except FAILURES as failure:
                failures[no] = failure
                continue
            totals |= {no: total} if no in alike else {}
            open_cases.append(_evidence(future.result(), no, only_gold, total - only_gold, None if no in alike else tuple(f.columns for f in frames[no])))
    rows = []
    for no, case in enumerate(cases, start=1):
        if no in failures:
            status, confidence, said = "error", 0.0, getattr(failures[no], "getCondition", lambda: None)() or type(failures[no]).__name__
        elif no in equal:
            status, confidence, said = "success", 1.0, "results are identical"
        else:
            status, confidence, said = "success", 0.5, "results differ" if no in alike else "results have different columns"
        rows.append((no, case.question, case.gold_query, case.generated_query, status, no in equal, confidence, said,
                     0 if no in equal else None if no in failures else totals.get(no)))
    results = spark.createDataFrame(rows, CASE_SCHEMA).withColumn("differences", F.array().cast("array<string>"))
    if not open_cases:
        return results
    asked = reduce(DataFrame.unionByName, open_cases).join(results.select("case_no", "question", "gold_query", "generated_query"), "case_no")
    said = F.array_sort(F.collect_list(F.struct("chunk_no", F.col("differences").cast("array<string>").alias("d"))))
    verdicts = judge(asked).groupBy("case_no").agg(
        F.bool_and("equivalent").alias("_e"), F.min("confidence").alias("_c"),
        # Chunks that find a difference come before the others.
        F.min(F.struct("equivalent", "chunk_no", "explanation"))["explanation"].alias("_x"),
        F.flatten(F.transform(said, lambda s: F.coalesce(s["d"], F.array().cast("array<string>")))).alias("_d"),
    )
    judged = results.join(verdicts, "case_no", "left")
    return judged.withColumns({
        "equivalent": F.coalesce("_e", "equivalent"), "confidence": F.coalesce("_c", "confidence"), "explanation": F.coalesce("_x", "explanation"),
        "differences": F.coalesce("_d", "differences"),
    }).select(*results.columns)


def _together(frames: dict) -> tuple[dict, dict]:
    """The only row of each of many frames of the same columns, by one job, and the failures by key. Where the job fails, each frame runs by itself."""
    if not frames:
        return {}, {}
    keys, out, failures = [*frames], {}, {}
    named = [frame.select(F.lit(i).alias("i"), "*") for i, frame in enumerate(frames.values())]
    try:
        return {keys[r[0]]: tuple(r)[1:] for r in reduce(DataFrame.union, named).collect()}, {}  # a row per frame
    except FAILURES:
        for key, frame in frames.items():
            try:
                out[key] = tuple(frame.first())
            except FAILURES as failure:
                failures[key] = failure
        return out, failures


def _differing_lines(gold: DataFrame, made: DataFrame, digits: int | None) -> DataFrame:
    """(line, n_left, n_right): the rows as JSON whose counts differ. Columns meet by position where number and types agree, else whole lines meet."""
    types = [[f.dataType for f in _comparable(x, None).schema] for x in (gold, made)]
    if types[0] == types[1]:
        diff = result_diff(gold, made, digits)
        values = [c for c in diff.columns if c not in ("n_left", "n_right")]
        return diff.select(F.to_json(F.struct(*values)).alias("line"), "n_left", "n_right")
    left, right = (x.toDF(*_distinct_names(x.columns)).select(F.to_json(F.struct("*")).alias("line")) for x in (gold, made))
    return result_diff(left, right, digits)


def _evidence(lines: DataFrame, case_no: int, only_gold: int, only_made: int, columns) -> DataFrame:
    """Rows for a judge: (case_no, chunk_no, gold_result, generated_result), each with ``ROWS_PER_CHUNK`` differing rows of a side at most.
    Without a differing row there is one chunk, which names the columns."""
    sided = lines.withColumn("side", F.col("n_left") > F.col("n_right"))
    numbered = number_rows(sided, ["line"], ["side"], "_r").select(
        "side", "line", F.floor((F.col("_r") - 1) / ROWS_PER_CHUNK).cast("int").alias("chunk_no"))
    named = lambda k: f"columns: {', '.join(columns[k])}\n" if columns else ""
    shown = lambda side: F.array_join(F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("line")))), "\n")
    first = lines.sparkSession.createDataFrame([(None, None, 0)], "side boolean, line string, chunk_no int")
    return numbered.union(first).groupBy("chunk_no").agg(
        F.concat(F.lit(f"{only_gold} rows only here\n{named(0)}"), shown(True)).alias("gold_result"),
        F.concat(F.lit(f"{only_made} rows only here\n{named(1)}"), shown(False)).alias("generated_result"),
    ).withColumn("case_no", F.lit(case_no))


def _only_query(sql: str) -> str:
    """The statement as a derived table, where nothing but a query parses: model-written commands are errors and never run."""
    return f"SELECT * FROM (\n{_bare(sql)}\n)"


def _bare(sql: str) -> str:
    return sql.strip().rstrip(";")


def score_against(df: DataFrame, reference: DataFrame, digits: int | None = 6) -> DataFrame:
    """One row: is a result similar to a reference result, and how many rows differ each way."""
    if not same_shape(df, reference):
        return df.sparkSession.createDataFrame([(False, None, None)], "is_similar boolean, n_extra long, n_missing long")
    diff = result_diff(df, reference, digits)
    extra, missing = F.greatest(F.col("n_left") - F.col("n_right"), F.lit(0)), F.greatest(F.col("n_right") - F.col("n_left"), F.lit(0))
    return diff.agg(
        (F.count("*") == 0).alias("is_similar"),
        F.coalesce(F.sum(extra), F.lit(0)).cast("long").alias("n_extra"),
        F.coalesce(F.sum(missing), F.lit(0)).cast("long").alias("n_missing"),
    )


def sql_pair_stats(results: DataFrame) -> DataFrame:
    """Totals over case results. Errors count as confidence 0, so the mean is over all cases."""
    ok = F.col("status") == "success"
    total = F.count("*")

    def rate(value: Column) -> Column:
        return F.when(total > 0, value / total).otherwise(0.0)

    return results.agg(
        total.alias("total"),
        F.count_if(ok & F.col("equivalent")).alias("equivalent"),
        F.count_if(ok & ~F.col("equivalent")).alias("non_equivalent"),
        F.count_if(~ok).alias("execution_errors"),
        rate(F.coalesce(F.sum(F.when(ok, F.col("confidence"))), F.lit(0.0))).alias("average_confidence"),
        rate(F.count_if(ok & F.col("equivalent"))).alias("equivalence_rate"),
    )


def sql_pair_report(results: DataFrame) -> DataFrame:
    """Report lines (line_no, line): the summary first, then each case."""
    stats = sql_pair_stats(results)

    def share(name: str, label: str) -> Column:
        percent = F.round(100 * F.col(name) / F.greatest(F.col("total"), F.lit(1)), 1)
        return F.format_string(f"- {label}: %d (%.1f%%)", F.col(name), percent)

    summary = stats.select(
        F.lit(0).alias("line_no"),
        F.concat_ws(
            "\n",
            F.lit("# SQL query evaluation"),
            F.format_string("- Test cases: %d", F.col("total")),
            share("equivalent", "Equivalent"),
            share("non_equivalent", "Not equivalent"),
            share("execution_errors", "Errors"),
            F.format_string("- Average confidence: %.2f", F.col("average_confidence")),
        ).alias("line"),
    )
    detail = results.select(
        F.col("case_no").alias("line_no"),
        F.concat(
            F.format_string("## Case %d: ", F.col("case_no")), F.col("question"),
            F.lit("\nStatus: "), F.col("status"),
            F.lit("\nEquivalent: "), F.col("equivalent").cast("string"),
            F.format_string("\nConfidence: %.2f", F.col("confidence")),
            F.lit("\nExplanation: "), F.col("explanation"),
            F.when(F.size("differences") > 0, F.concat(F.lit("\nDifferences: "), F.array_join("differences", "; "))).otherwise(""),
            F.lit("\nGold:\n"), F.col("gold_query"), F.lit("\nGenerated:\n"), F.col("generated_query"),
        ).alias("line"),
    )
    return summary.unionByName(detail)
