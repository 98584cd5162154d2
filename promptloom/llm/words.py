"""Words of whole texts on their UTF-8 bytes: ASCII letters folded to small ones, runs of letters, digits and non-ASCII characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The same words as an expression: Java and RE2 agree on it.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Byte by byte, so places in the folded text are places in the text: capitals become small, other ASCII but digits a space.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def fold(text: bytes | None) -> bytes:
    """The text with folded letters and a space for every byte outside words. Null counts as empty; ``split()`` then gives the words."""
    return text.translate(_FOLD) if text else b""


def words_column(text: Column) -> Column:
    """The words of a string column; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL), F.lit(WORD), F.lit(0))
