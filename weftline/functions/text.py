"""Small text predicates shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space.
_SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACES))


def is_blank(text: Column) -> Column:
    return text.isNull() | (trimmed(text) == "")


def message(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def collected(*checks: Column) -> Column:
    """Array of the texts of all checks that failed, in the given order."""
    return F.filter(F.array(*checks), lambda e: e.isNotNull())
