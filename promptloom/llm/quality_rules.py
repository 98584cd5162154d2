"""Quality rules: decision lists learned by sequential covering, applied as ordered Spark conditions.

A rule is a conjunction of thresholds on text statistics that finds rejected documents. Rules are grown on two thirds of a
labelled sample by information gain and pruned on the rest; what a rule covers is set aside before the next one is grown.
Every count comes from a Spark aggregation over binned statistics: the driver sees a histogram of fixed size, never rows.
The learned list becomes one CASE expression, so scoring is a scan of built-in functions without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.llm.common import NOT_SPACE, hold, labelled_rows, let, release, settle, words_of
from promptloom.storage import materialise

# The base rules.
MIN_WORDS = 50
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3
# Low bits of a sort key that hold a window's place.
POSITION_BITS = 22

FEATURES = (
    "n_words", "word_length", "symbol_share", "mark_share", "upper_share", "dup_line_share", "repeat_share", "digit_share", "words_per_line",
)


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold``, or ``feature < threshold`` where ``above`` is false."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return (value >= self.threshold) if self.above else (value < self.threshold)


Rule = tuple[Condition, ...]


def statistics(text: Column) -> list[dict[str, Column]]:
    """Steps of named columns; each step may use the ones before it. Null and empty texts give zeros.

    Windows are compared by hash first. Only a text with a hash that comes twice is sorted, as longs that hold hash bits above the
    position, and neighbours of equal bits are compared word by word. Where different windows share bits, the text is sorted again by words.
    """
    whole = F.coalesce(text, F.lit(""))
    line = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(NOT_SPACE))
    at = lambda x: x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")
    bits = lambda x: F.shiftright(x, POSITION_BITS)
    window = lambda p: [F.get("_words", p + j) for j in range(WINDOW)]
    same = lambda p, q: _all(a == b for a, b in zip(window(p), window(q)))
    near = lambda k: (F.get("_sorted", k - 1), F.get("_sorted", k + 1))
    clash = F.exists(F.sequence(F.lit(1), F.size("_sorted") - 1), lambda k: (
        bits(F.get("_sorted", k)) == bits(F.get("_sorted", k - 1))) & ~same(at(F.get("_sorted", k)), at(F.get("_sorted", k - 1))))
    repeated = F.transform("_sorted", lambda x, k: F.when(
        (bits(near(k)[0]) == bits(x)) | (bits(near(k)[1]) == bits(x)), at(x)))
    by_words = let(F.sort_array(F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda p: F.struct(
        F.array(*window(p)).alias("w"), p.alias("i")))), lambda s: F.transform(s, lambda x, k: F.when(
            (F.get(s, k - 1)["w"] == x["w"]) | (F.get(s, k + 1)["w"] == x["w"]), x["i"])))
    covered = lambda places: F.size(F.array_distinct(F.flatten(F.transform(
        F.filter(places, lambda p: p.isNotNull()), lambda p: F.array(*[p + j for j in range(WINDOW)])))))
    return [
        {"_text": whole},
        {"_words": words_of(F.col("_text")), "_lines": line},
        {
            "_windows": F.when(F.size("_words") >= WINDOW, F.transform(
                F.slice("_words", 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))),
                lambda w, i: F.xxhash64(w, *[F.get("_words", i + j) for j in range(1, WINDOW)]))).otherwise(F.array().cast("array<bigint>")),
            "n_words": F.size("_words").cast("long"),
            "_joined": F.array_join("_words", ""),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_n_lines": F.size("_lines"),
        },
        {
            "_sorted": F.when(
                F.size(F.array_distinct("_windows")) < F.size("_windows"),
                F.sort_array(F.transform("_windows", lambda h, i: F.shiftleft(h, POSITION_BITS).bitwiseOR(i.cast("long"))))),
            "word_chars": F.char_length("_joined").cast("long"),
            "n_symbols": F.regexp_count("_joined", F.lit(SYMBOLS)).cast("long"),
            "_n_marks": F.regexp_count("_joined", F.lit("[!?]")),
            "_n_upper": F.char_length("_joined") - F.char_length(F.regexp_replace("_joined", "[A-Z]+", "")),
            "_n_digits": F.char_length("_joined") - F.char_length(F.regexp_replace("_joined", "[0-9]+", "")),
        },
        {
            "n_repeat_words": F.when(F.col("_sorted").isNull(), F.lit(0)).when(
                (F.size("_words") >= 1 << POSITION_BITS) | clash, covered(by_words)).otherwise(covered(repeated)).cast("long"),
        },
        {
            "word_length": _share("word_chars", "n_words"), "symbol_share": _share("n_symbols", "word_chars"),
            "mark_share": _share("_n_marks", "n_words"), "upper_share": _share("_n_upper", "word_chars"),
            "dup_line_share": _share("n_dup_lines", "_n_lines"), "repeat_share": _share("n_repeat_words", "n_words"),
            "digit_share": _share("_n_digits", "word_chars"), "words_per_line": _share("n_words", "_n_lines"),
        },
    ]


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def with_statistics(df: DataFrame, text: str) -> DataFrame:
    for step in statistics(F.col(text)):
        df = df.withColumns(step)
    return df


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def learn(labelled: DataFrame, features: tuple[str, ...] = FEATURES, cuts: int = 16, max_rules: int = 8, max_conditions: int = 3,
          min_precision: float = 0.95, min_cover: int = 5) -> list[Rule]:
    """Ordered rules for rows with ``_label`` 0, from rows of (_id, _label, the features).

    A rule is kept when at least ``min_precision`` of what it covers among the pruning rows (with one good row added as a prior)
    is labelled 0. No rows, or rows of one label only, give no rule.
    """
    edges = _edges(labelled, features, cuts)
    if edges is None:
        return []
    binned = materialise(labelled.select(
        (F.col("_label") == 0).alias("bad"), (F.pmod(F.xxhash64(F.col("_id"), F.lit(7)), F.lit(3)) != 0).alias("grow"),
        *[sum([(F.col(f) >= e).cast("int") for e in edges[f]], F.lit(0)).alias(f"b_{f}") for f in features],
    ), "rule-bins")
    rules: list[Rule] = []
    left = binned
    while len(rules) < max_rules:
        grown = _grow(left.filter("grow"), features, edges, max_conditions)
        if not grown:
            break
        kept = _prune(left.filter("not grow"), grown, min_precision, min_cover)
        if not kept:
            break
        rules.append(tuple(Condition(f, above, edges[f][b - 1]) for f, above, b in kept))
        left = left.filter(~_covers(kept))
    return rules


def _edges(labelled: DataFrame, features, cuts: int) -> dict[str, list[float]] | None:
    """Thresholds per feature: quantiles of the good and of the bad rows, exact over the bounded sample."""
    at = [i / cuts for i in range(cuts + 1)]
    exact = labelled.groupBy((F.col("_label") == 0).alias("bad")).agg(*[F.percentile(f, F.array(*map(F.lit, at))).alias(f) for f in features])
    found = exact.collect()
    if len(found) < 2:
        return None
    return {f: sorted({x for row in found for x in row[f]}) for f in features}


def _covers(conditions) -> Column:
    out = F.lit(True)
    for f, above, b in conditions:
        out = out & ((F.col(f"b_{f}") >= b) if above else (F.col(f"b_{f}") < b))
    return out


def _grow(rows: DataFrame, features, edges, most: int):
    """Add the threshold with the largest information gain until only bad rows are covered or nothing is gained."""
    chosen: list[tuple[str, bool, int]] = []
    while len(chosen) < most:
        bins = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"b_{f}").alias("b")) for i, f in enumerate(features)]))
        counted = rows.filter(_covers(chosen)).select("bad", bins.alias("x")).groupBy("x.f", "x.b").agg(
            F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        table = {f: [[0, 0] for _ in range(len(edges[f]) + 1)] for f in features}
        for r in counted:
            table[features[r["f"]]][r["b"]] = [r["p"], r["n"]]
        p0, n0 = (sum(x[k] for x in table[features[0]]) for k in (0, 1))
        if not p0 or not n0:
            break
        before, best = math.log2(p0 / (p0 + n0)), (1e-9, None)
        for f in features:
            p = n = 0
            for b in range(len(edges[f]), 0, -1):
                p, n = p + table[f][b][0], n + table[f][b][1]
                for above, pp, nn in ((True, p, n), (False, p0 - p, n0 - n)):
                    if pp:
                        gain = pp * (math.log2(pp / (pp + nn)) - before)
                        if gain > best[0]:
                            best = (gain, (f, above, b))
        if best[1] is None:
            break
        chosen.append(best[1])
    return chosen


def _prune(rows: DataFrame, grown, min_precision: float, min_cover: int):
    """The shortest beginning of the conjunction with the best value (bad - good) / (bad + good) on the pruning rows."""
    counts = rows.agg(*[F.count_if(_covers(grown[:k]) & hit).alias(f"{name}{k}") for k in range(1, len(grown) + 1)
                        for name, hit in (("p", F.col("bad")), ("n", ~F.col("bad")))]).first()
    best, out = -2.0, None
    for k in range(1, len(grown) + 1):
        p, n = counts[f"p{k}"], counts[f"n{k}"]
        if p + n >= min_cover and p / (p + n + 1) >= min_precision and (p - n) / (p + n) > best:
            best, out = (p - n) / (p + n), grown[:k]
    return out


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that fires, from 1; 0 where none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        fires = rule[0].column()
        for c in rule[1:]:
            fires = fires & c.column()
        out = F.when(fires, k) if out is None else out.when(fires, k)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", fit_rows: int = 10_000,
          **options) -> DataFrame:
    """All rows held in ``_row`` with their statistics, ``base_failed``, ``rule`` (0: none) and ``kept``.

    ``fit_rows`` bounds the labelled sample the list is learned from; every document is judged. A null text counts as empty:
    it has no words and fails the base rule. Rows are judged one by one, so repeated rows get equal verdicts, and other columns
    of any name stay in ``_row``. Without usable labels only the base rules apply; no documents give no rows.
    """
    sample = with_statistics(labelled_rows(docs.select(F.col(doc_id).alias("_key"), F.col(text).alias("_source")), labels.select(
        F.col(doc_id).alias("_key"), F.col(label).alias("_quality")), fit_rows, ["_source"], "_key", "_quality"), "_source")
    rules = learn(materialise(sample.select("_id", "_label", *FEATURES), "rule-sample"), **options)
    out = with_statistics(hold(docs, _source=F.col(text)), "_source").withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return settle(out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that neither the base rules nor the learned list reject, with their columns."""
    return release(judge(docs, labels, **options).filter("kept"))
