"""Word test on names (a name needs more than one word to count as a taxon)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separators equal to Python's ``str.split()`` without arguments,
# i.e. Unicode white space (UNICODE_CHARACTER_CLASS makes \s cover U+00A0 and
# friends) plus the information separators U+001C..U+001F.
WORD_SEPARATORS = r"(?U)[\s\x1c-\x1f]+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(name: str | Column) -> Column:
    """Number of non-empty words; NULL for a NULL name."""
    parts = F.split(_col(name), WORD_SEPARATORS)
    return F.size(F.filter(parts, lambda w: w != F.lit("")))


def is_multiword(name: str | Column) -> Column:
    """True when the name has more than one word; NULL names are never true."""
    return F.coalesce(word_count(name) > F.lit(1), F.lit(False))
