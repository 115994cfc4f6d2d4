"""Text helpers shared by the other column functions.

Blank means '' or NULL. Patterns carry (?U) where the text may hold non-ASCII digits or blanks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPECIAL = ".^$*+?()[]{}|\\/-"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def null_to_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def is_blank(text: Column) -> Column:
    return null_to_blank(text) == ""


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, NULL if there is none."""
    return blank_to_null(F.regexp_extract(text, pattern, group))


def quoted(literal: str) -> str:
    """The text as a pattern that matches just itself."""
    return "".join("\\" + ch if ch in SPECIAL else ch for ch in literal)


def to_int(text: Column) -> Column:
    """Whole number in text, NULL if it is not one (``17.0`` is not).

    Text without a digit is not cast: a failing cast costs an exception, which is dear if most rows have no number.
    """
    return F.when(text.rlike("[0-9]"), strip(text).try_cast("bigint"))
