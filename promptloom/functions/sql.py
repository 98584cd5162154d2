"""SQL text as a stream of tokens: enough to tell code from literals, quoted names and comments, and to see which tables a query reads.

There is no grammar here. Where the tables in scope cannot be told from the tokens, callers are told so.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Comments, literals, quoted names, words, numbers, space, and any other character. What is not closed runs to the end.
# Possessive repeats keep the matcher from backtracking into long literals.
_LINE, _BLOCK = r"--[^\n]*+", r"/\*(?:[^*]++|\*(?!/))*+(?:\*/)?"
_LITERAL, _NAMES = r"'(?:[^']++|'')*+'?", r'"(?:[^"]++|"")*+"?|`[^`]*+`?'
TOKEN = rf"{_LINE}|{_BLOCK}|{_LITERAL}|{_NAMES}|[A-Za-z_][A-Za-z0-9_$]*+|[0-9]++(?:\.[0-9]++)?|\s++|[\s\S]"
_COMMENT, _QUOTED = r"^(?:--|/\*)", r"""^['"`]"""
FILLER = "\u0001"

_WORD = r"[A-Za-z_][A-Za-z0-9_$]*"
_NOT_AN_ALIAS = r"(?!(?:where|on|using|join|inner|left|right|full|cross|natural|outer|group|order|having|limit|union|except|intersect|window|qualify|as|set|when|then|values)\b)"
_TABLE = rf"{_WORD}(?: \. {_WORD})*(?: (?:as )?{_NOT_AN_ALIAS}{_WORD})?"
_TABLES = rf"(?i)\b(?:from|join) ({_TABLE}(?: , {_TABLE})*)"
_DEFINED = rf"(?i)(?:\bwith(?: recursive)?|,) ({_WORD})(?: \( [^()]* \))? as \("
# A derived table or a table function, whose columns only a planner knows.
_DERIVED = rf"(?i)\b(?:from|join) (?:lateral )?\(|\b(?:from|join) {_WORD} \(|\b(?:from|join) {_TABLE}(?: , {_TABLE})* , (?:lateral )?\("


def tokens(sql: Column) -> Column:
    """All tokens of a text in order; joined they give the text."""
    return F.regexp_extract_all(sql, F.lit(TOKEN), F.lit(0))


def masked(sql: Column) -> Column:
    """The text with as many filler characters in place of literals and quoted names and spaces in place of comments, so that places stay the same."""
    def mask(t: Column) -> Column:
        return F.when(t.rlike(_COMMENT), F.repeat(F.lit(" "), F.length(t))).when(t.rlike(_QUOTED), F.repeat(F.lit(FILLER), F.length(t))).otherwise(t)

    return F.array_join(F.transform(tokens(sql), mask), "")


def code_tokens(sql: Column) -> Column:
    """Tokens without space and comments; quoted names are bare names, literals keep their quotes."""
    kept = F.filter(tokens(sql), lambda t: ~t.rlike(_COMMENT) & ~t.rlike(r"^\s"))
    return F.transform(kept, lambda t: F.when(t.rlike(r'^["`]'), F.regexp_replace(t, r'^["`]|["`]$', "")).otherwise(t))


def equalities(code: Column) -> Column:
    """Distinct (qualifier, column_name, literal) of ``column = 'literal'`` in code tokens, names in upper case; no qualifier is null."""
    at = lambda i: F.get(code, i)
    name = lambda i: at(i).rlike(f"^{_WORD}$")
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(code) - 2, F.lit(1))), lambda i: (at(i) == "=") & name(i - 1) & at(i + 1).startswith("'"))
    return F.array_distinct(F.transform(places, lambda i: F.struct(
        F.when((at(i - 2) == ".") & name(i - 3), F.upper(at(i - 3))).alias("qualifier"),
        F.upper(at(i - 1)).alias("column_name"),
        F.replace(F.regexp_replace(at(i + 1), r"^'|'$", ""), F.lit("''"), F.lit("'")).alias("literal"),
    )))


def scope(code: Column) -> Column:
    """Struct of what a query reads: ``tables`` (name, alias) in order and in upper case, and ``open``: whether it also reads something whose columns cannot be
    known, that is a derived table, a table function or a common table expression. Those are not among ``tables``, and an alias without AS must not be a key word."""
    # Literals cannot pass for code here.
    line = F.array_join(F.transform(code, lambda t: F.when(t.startswith("'"), F.lit("'")).otherwise(t)), " ")
    defined = F.transform(F.regexp_extract_all(line, F.lit(_DEFINED), F.lit(1)), F.upper)
    listed = F.flatten(F.transform(F.regexp_extract_all(line, F.lit(_TABLES), F.lit(1)), lambda x: F.split(F.upper(x), " , ")))
    named = F.transform(listed, lambda x: F.struct(
        F.regexp_extract(x, rf"^(?:{_WORD} \. )*({_WORD})", 1).alias("name"), F.regexp_extract(x, rf"({_WORD})$", 1).alias("alias")))
    return F.struct(
        F.filter(named, lambda x: ~F.array_contains(defined, x["name"])).alias("tables"),
        (F.exists(named, lambda x: F.array_contains(defined, x["name"])) | line.rlike(_DERIVED)).alias("open"),
    )


def ends_with_semicolon(sql: Column) -> Column:
    """Whether the last code character is a semicolon."""
    return masked(sql).rlike(r";\s*$")


def ends_in_line_comment(sql: Column) -> Column:
    return F.element_at(F.concat(F.array(F.lit("")), tokens(sql)), -1).startswith("--")


def is_blank(sql: Column) -> Column:
    """Whether there is nothing but space and comments."""
    return masked(sql).rlike(r"^\s*$")
