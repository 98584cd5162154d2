"""Text clean-up and SQL-text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.functions import sql

FENCE = "```"
# The head of a common table expression (the word "with" alone may be prose), or a select.
_STATEMENT = (
    r'(?s)(?i:\bwith\s+(?:recursive\s+)?["`]?\w+["`]?(?:\s*\([^)]*\))?\s+as\s*\().*$|\bSELECT\b.*$'
    r"|(?im:(?:^|(?<=[:;(]))[ \t(]*+(?=select\b))(?s:.*)\z|(?i:\bselect\b(?=.*?\bfrom\b)).*$"
)


# What may be a statement behind another one.
_MORE = r"(?i)\b(?:select|with)\b"


def ascii_clean(value: Column, dtype: T.DataType) -> Column:
    """Drop non-ASCII characters from every string inside a value of type ``dtype``."""
    if isinstance(dtype, T.StringType):
        return F.regexp_replace(value, r"[^\x00-\x7F]", "")
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: ascii_clean(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _k, v: ascii_clean(v, dtype.valueType))
    if isinstance(dtype, T.StructType):
        fields = [ascii_clean(value.getField(f.name), f.dataType).alias(f.name) for f in dtype]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def ascii_clean_columns(df: DataFrame) -> DataFrame:
    return df.select(*[ascii_clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def strip_fence(text: Column) -> Column:
    """Trim, then drop an opening code-fence line and a closing one."""
    body = F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "")
    opened = F.regexp_replace(body, r"^```[^\n]*(\n|$)", "")
    return F.when(body.startswith(FENCE), F.regexp_replace(opened, r"(^|\n)```[^\n]*$", "")).otherwise(body)


def extract_sql(text: Column) -> Column:
    """The SQL inside model text: from the first statement after any code fence, without the prose that follows the last ``;`` of its code. A text that
    is a statement comes back whole. Null when there is none.

    A statement begins with a common table expression or with ``select``: at the start of the text, of a line or after ``:``, ``;`` or a parenthesis, or
    anywhere in capitals, or within prose if a ``from`` follows. Semicolons, quotes and words inside literals, quoted names and comments do not count.
    """
    body = F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "")
    fence = F.locate(FENCE, body)
    # What a fence encloses ends where it closes.
    body = F.when(fence > 0, F.substring_index(F.substring(body, fence + len(FENCE), F.length(body)), FENCE, 1)).otherwise(body)
    body = F.regexp_replace(body, r"\s+$", "")
    statement = F.nullif(F.regexp_replace(F.regexp_extract(body, _STATEMENT, 0), r"^\s+", ""), F.lit(""))

    def cut(s: Column) -> Column:
        """``s`` is (sql, code), the text and its masked form of the same length."""
        inner = F.regexp_replace(s["code"], r"[;\s]+$", "")
        tail = F.substring_index(inner, ";", -1)
        prose = inner.contains(";") & ~tail.rlike(_MORE)
        kept = F.substring(s["sql"], F.lit(1), F.when(prose, F.length(inner) - F.length(tail)).otherwise(F.length(inner)))
        # Comments behind the last code stay, unless prose was cut or a semicolon closes the code before them.
        closed = s["code"].rlike(r";\s*$")
        return F.when(closed & ~prose, F.concat(kept, F.lit(";"))).when(prose, kept).otherwise(s["sql"])

    found = F.transform(F.array(F.struct(statement.alias("sql"), sql.masked(statement).alias("code"))), cut)
    return F.when(statement.isNotNull(), found[0])


def terminate_sql(query: Column) -> Column:
    """Trim and make sure the statement ends with ``;``: that of its code, be there comments behind it or not."""
    trimmed = F.regexp_replace(F.regexp_replace(query, r"^\s+", ""), r"\s+$", "")
    mark = F.when(sql.ends_in_line_comment(trimmed), "\n;").otherwise(";")
    return F.when(sql.ends_with_semicolon(trimmed), trimmed).otherwise(F.concat(trimmed, mark))


def token_budget(prompt: Column, max_new_tokens: int = 0) -> Column:
    """Rough token need: a quarter of the characters, rounded up, plus the tokens to generate."""
    return (F.ceil(F.length(prompt) / 4) + max_new_tokens).cast("long")


def question_key(question: Column) -> Column:
    """Equal for questions that differ only in case and white space."""
    return F.lower(F.trim(F.regexp_replace(question, r"\s+", " ")))


def chunk_text(text: Column, size: int = 1024, overlap: int = 0) -> Column:
    """Array of character chunks; neighbours share ``overlap`` characters. Empty text has none."""
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("need size > 0 and 0 <= overlap < size")
    step = size - overlap
    last = F.greatest(F.ceil((F.length(text) - overlap) / step) - 1, F.lit(0)).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i * step + 1, F.lit(size)))
    return F.when(F.length(text) > 0, chunks).otherwise(F.array().cast("array<string>"))


def chunk_rows(df: DataFrame, text: str, ids: list[str], size: int = 1024, overlap: int = 0, name: str = "chunk") -> DataFrame:
    """One row per chunk: (ids, ``chunk_no`` from 0, ``name``). The outer form keeps the planner from cutting
    the text again for a filter on the number of chunks."""
    chunks = df.select(*ids, F.posexplode_outer(chunk_text(F.col(text), size, overlap)).alias("chunk_no", name))
    return chunks.filter(F.col("chunk_no").isNotNull())


def similarity(a: Column, b: Column) -> Column:
    """1 − edit distance / longer length, on the code points of trimmed lower-case text; two empty texts are equal."""
    x, y = (F.lower(F.trim(c)) for c in (a, b))
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(x, y) / longest)
