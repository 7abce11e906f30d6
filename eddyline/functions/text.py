"""Text splitting and strict number parsing as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word separator is a run of non-word characters, where a
# word character is ASCII [A-Za-z0-9_] (so accented letters split words).
WORD_SEPARATOR = r"\W+"
WORD = r"\w+"
INT_PATTERN = r"^[+-]?[0-9]+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(col, sep: str = ",") -> Column:
    """Split on a literal separator and drop trailing empty parts.

    ``a,1,123,`` gives three parts and ``a,1,`` two; interior empties stay.
    """
    esc = re.escape(sep)
    if len(sep) == 1:   # trailing run of one character: a plain trim, no regex
        return F.split(F.rtrim(_c(col), F.lit(sep)), esc)
    return F.split(F.regexp_replace(_c(col), f"(?:{esc})+\\z", ""), esc)


def strict_int(col) -> Column:
    """Digits with an optional sign, in INT range; anything else is null."""
    c = _c(col)
    return F.when(c.rlike(INT_PATTERN), c.try_cast("int"))


def strict_long(col) -> Column:
    c = _c(col)
    return F.when(c.rlike(INT_PATTERN), c.try_cast("bigint"))


def tokens(col) -> Column:
    """Lower-cased words of a line as an array, empty tokens removed: the
    maximal runs of word characters, i.e. the non-empty parts of a split on
    ``WORD_SEPARATOR`` (extracting them is about twice as fast)."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(WORD), 0)


def first_three(col) -> Column:
    """Struct of the first three lower-cased comma fields, or null when the
    line has fewer than three parts (after dropping trailing empties)."""
    f = java_split(F.lower(_c(col)), ",")
    return F.when(F.size(f) > 2, F.struct(
        f.getItem(0).alias("f0"), f.getItem(1).alias("f1"), f.getItem(2).alias("f2")))


def prefix_chars_array(col, prefix: str) -> Column:
    """Characters of ``prefix + line`` as an array of one-character strings."""
    s = F.concat(F.lit(prefix), _c(col))
    return F.when(F.length(s) == 0, F.array().cast("array<string>")).otherwise(F.split(s, ""))
