"""Secret scans: named patterns, and sliding-window Shannon entropy over candidate strings, all in built-in functions.

Spans come from splitting: the parts between matches and the matches alternate, so their lengths give every match's place.
A candidate is a long run of token characters with a digit and a letter. Its window moves by one character at a time; the sum
of c * log2(c) over the window's character counts is updated for the one that enters and the one that leaves, and the
entropy is log2(width) minus that sum over the width. The threshold depends on the character class of the candidate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.llm.common import hold, let, settle

# The base patterns in the order of their kinds, with the least length of what they must hold.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LENGTH = 6
KINDS = ("assign", "access", "hex", "entropy")

# Character classes of candidates, tried in turn: pattern, and the least entropy in bits of a window.
CLASSES = {"hex": ("^[0-9a-fA-F]+$", 3.0), "alnum": ("^[A-Za-z0-9]+$", 3.6), "base64": (".", 3.7)}
# Strings that look random and are not: counting and alphabet runs, placeholders, addresses, paths and plain words joined by hyphens.
ALLOWED = (
    "(?i)example|changeme|placeholder|dummy|redacted|your[_-]?(?:api|key|token)|xxxx|0123456789|1234567890|abcdefghij|"
    r"^[A-Za-z/_=+-]*[0-9]{0,4}$|^[0-9]+(?:[-_/][0-9]+)*$|^(?:[A-Za-z]+[-_/])+[A-Za-z]*[0-9]{0,4}$"
)
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}"
RUN = 128  # matches of a text that are placed, or compared, together
SPAN = "struct<start:int,kind:int,stop:int,text:string>"


def _nothing() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def spans(text: Column, pattern: str, kind: int, guard: Column | None = None) -> Column:
    """(start, kind, stop, text) of the leftmost matches that do not overlap, in code points; the pattern never matches nothing.

    ``guard`` is a cheap condition that holds wherever the pattern may match.
    """
    found, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["gap"])
        return let(F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.char_length(x["match"])).alias("stop"), x["match"].alias("text")),
                   lambda p: F.struct(p["stop"].alias("at"), F.concat(state["out"], F.array(p)).alias("out")))

    def join(state: Column, run: Column) -> Column:
        moved = F.transform(run["out"], lambda x: F.struct(
            (x["start"] + state["at"]).alias("start"), x["kind"].alias("kind"), (x["stop"] + state["at"]).alias("stop"), x["text"].alias("text")))
        return F.struct((state["at"] + run["at"]).alias("at"), F.concat(state["out"], F.array(moved)).alias("out"))

    # There is one part more than there are matches; zipping leaves its match null.
    zipped = F.filter(F.arrays_zip(parts.alias("gap"), found.alias("match")), lambda x: x["match"].isNotNull())
    runs = let(zipped, lambda z: F.transform(F.sequence(F.lit(0), F.floor(F.size(z) / RUN).cast("int")), lambda b: F.aggregate(
        F.slice(z, b * RUN + 1, F.lit(RUN)), F.struct(F.lit(0).alias("at"), _nothing().alias("out")), step)))
    placed = F.flatten(F.aggregate(runs, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("out")), join, lambda s: s["out"]))
    return F.when(text.rlike(pattern) if guard is None else guard, placed).otherwise(_nothing())


def apart(candidates: Column, base: Column) -> Column:
    """The candidates that overlap no span of ``base``, which is in order of start. A candidate is compared with the first start and last stop
    of each run of ``base``, and with the spans of a run only where these leave it open."""
    meets = lambda x, first, last: (first < x["stop"]) & (x["start"] < last)
    run = lambda r: F.struct(r[0]["start"].alias("first"), F.array_max(F.transform(r, lambda b: b["stop"])).alias("last"), r.alias("spans"))
    count = F.ceil(F.size(base) / RUN).cast("int")
    runs = F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda b: let(F.slice(base, (b - 1) * RUN + 1, F.lit(RUN)), run)))
    hit = lambda x, r: meets(x, r["first"], r["last"]) & F.exists(r["spans"], lambda b: meets(x, b["start"], b["stop"]))
    return F.when(count > 0, let(runs, lambda rs: F.filter(candidates, lambda x: ~F.exists(rs, lambda r: hit(x, r))))).otherwise(candidates)


def window_entropy(text: Column, width: int) -> Column:
    """Largest Shannon entropy, in bits, of the windows of ``width`` characters of a text of at least that length."""
    weight = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(width + 2)])
    held = lambda counts, x: F.coalesce(F.try_element_at(counts, x), F.lit(0))
    put = lambda counts, x, n: F.map_concat(F.map_filter(counts, lambda k, _: k != x), F.create_map(x, n))

    def step(chars: Column):
        def run(state: Column, i: Column) -> Column:
            enter, leave = F.get(chars, i), F.get(chars, i - width)
            before = held(state["counts"], enter)
            entered = F.struct((state["sum"] + F.get(weight, before + 1) - F.get(weight, before)).alias("sum"), put(state["counts"], enter, before + 1).alias("counts"))

            def left(s: Column) -> Column:
                n = held(s["counts"], leave)
                return F.struct((s["sum"] - F.get(weight, n) + F.get(weight, n - 1)).alias("sum"), put(s["counts"], leave, n - 1).alias("counts"))

            moved = let(entered, lambda s: F.when(i < width, s).otherwise(left(s)))
            return let(moved, lambda s: F.struct(
                s["sum"].alias("sum"), s["counts"].alias("counts"),
                F.when(i >= width - 1, F.least(state["low"], s["sum"])).otherwise(state["low"]).alias("low")))
        return run

    none = F.struct(F.lit(0.0).alias("sum"), F.create_map().cast("map<string,int>").alias("counts"), F.lit(1e9).alias("low"))
    low = lambda chars: F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), none, step(chars), lambda s: s["low"])
    return let(F.split(text, ""), lambda chars: F.lit(math.log2(width)) - low(chars) / width)


def random_looking(text: Column, width: int) -> Column:
    """Has a digit and a letter, is not on the allow-list, and reaches its character class's entropy in some window."""
    limit = None
    for pattern, bits in CLASSES.values():
        limit = F.when(text.rlike(pattern), bits) if limit is None else limit.when(text.rlike(pattern), bits)
    return text.rlike("[0-9]") & text.rlike("[A-Za-z]") & ~text.rlike(ALLOWED) & (window_entropy(text, width) >= limit)


def scan(docs: DataFrame, text: str = "text", width: int = 20) -> DataFrame:
    """All rows held in ``_row`` with n_assign, n_access, n_hex, base_sha256, spans, and the arrays ``base`` and ``found``.

    ``base`` are the spans of the named patterns by start, then kind; ``found`` adds candidates of at least ``width`` characters with
    high entropy that overlap none of them. Texts are read whole. A null or empty text has no spans, counts of 0, the digest of the
    empty string and empty ``spans``. Rows are scanned one by one, so repeated rows give equal results; other columns of any name stay in
    ``_row``. No documents give no rows.
    """
    df = hold(docs, _source=F.coalesce(F.col(text), F.lit("")))
    source = F.col("_source")
    assigned = F.filter(spans(source, ASSIGN, 0, source.rlike("[:=]")), lambda x: F.char_length(F.regexp_extract(x["text"], ASSIGN, 2)) >= ASSIGN_LENGTH)
    df = df.withColumns({
        "base": F.sort_array(F.concat(assigned, spans(source, ACCESS, 1, F.contains(source, F.lit("AKIA"))), spans(source, HEX, 2))),
        "_runs": spans(source, CANDIDATE % width, 3),
    })
    extra = F.filter(apart(F.col("_runs"), F.col("base")), lambda x: random_looking(x["text"], width))
    df = df.withColumn("found", F.when(F.size("_runs") > 0, F.sort_array(F.concat("base", extra))).otherwise(F.col("base")))
    name = F.array(*map(F.lit, KINDS))
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"], x["stop"])), ",")
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return settle(df.select(
        "_row", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(shown("base"), 256).alias("base_sha256"), shown("found").alias("spans"), "base", "found",
    ))
