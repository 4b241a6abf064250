"""White space and empty text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(text: Column) -> Column:
    """Trim every Unicode white space, where ``trim`` by itself takes blanks only."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """NULL or empty, the cases a fallback chain passes over."""
    return text.isNull() | (text == "")


def or_null(text: Column) -> Column:
    """Empty text as NULL."""
    return F.nullif(text, F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
