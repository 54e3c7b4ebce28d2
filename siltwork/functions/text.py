"""Strings: splitting, word normalisation, pattern and prefix tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LATIN_LETTER = "[a-z]"


def part(col: Column, separator: str, index: int) -> Column:
    """The trimmed ``index``-th piece of ``col``; null past the end.

    ``separator`` is a regular expression, as in ``split``.
    """
    return F.trim(F.get(F.split(col, separator), F.lit(index)))


def words(col: Column, separator: str = " ") -> Column:
    """One row per piece of ``col``."""
    return F.explode(F.split(col, separator))


def normal_word(col: Column) -> Column:
    """Lower case without surrounding spaces; other white space stays."""
    return F.lower(F.trim(col))


def is_word(col: Column) -> Column:
    """True for a non-null word with at least one lower-case Latin letter."""
    return col.isNotNull() & col.rlike(LATIN_LETTER)


def has_prefix(col: Column, prefix: str) -> Column:
    return F.substring(col, 1, len(prefix)) == prefix


def joined(separator: str, *cols: Column) -> Column:
    """Concatenation that skips nulls."""
    return F.concat_ws(separator, *cols)
