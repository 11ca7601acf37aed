"""Cleaning of raw text: trimming, categories, flags and weekly hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a space at the ends (the space separators of Unicode; tab, CR and LF
# stay), how flags are spelled, and the shape of a number.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
TRUE_SPELLINGS = ("true", "1", "yes")
FALSE_SPELLINGS = ("false", "0", "no")
NUMBER = r"^\s*([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?|nan)\s*\z"


def trim_spaces(text: Column) -> Column:
    """Strip space separators from both ends; the built-in ``trim`` knows U+0020 alone."""
    return F.trim(text, F.lit(SPACE_SEPARATORS))


def category(text: Column) -> Column:
    return F.lower(trim_spaces(text))


def flag(text: Column) -> Column:
    """True, false, or NULL for any other spelling (a cast would also accept "t" and "y")."""
    word = category(text)
    return F.when(word.isin(*TRUE_SPELLINGS), True).when(word.isin(*FALSE_SPELLINGS), False)


def hours_text(text: Column) -> Column:
    """Drop every "h" and read a comma as the decimal point: "37,5h" becomes "37.5"."""
    return F.replace(F.replace(category(text), F.lit("h"), F.lit("")), F.lit(","), F.lit("."))


def hours(text: Column, permissive: bool = False) -> Column:
    """Weekly hours as a double. "35h30" reads as 3530; the parse check reports such values.

    The shape is checked first because a cast to double takes a trailing "d" or "f" as a suffix.
    """
    number = hours_text(text)
    if permissive:
        return F.when(number.rlike(NUMBER), number.try_cast("double"))
    return F.when(number.isNull() | number.rlike(NUMBER), number.cast("double")).otherwise(
        F.raise_error(F.concat(F.lit("weekly hours are not a number: "), text))
    )
