"""Text expressions (PRJ-8, FLT-7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.registry import NA_TOKENS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair_text(col) -> Column:
    """PRJ-8: invalid UTF-8 sequences become the replacement character."""
    return F.make_valid_utf8(_c(col))


def has_non_ascii(col) -> Column:
    """FLT-7: any character outside 7-bit ASCII, over the whole text."""
    return _c(col).rlike("[^\\x00-\\x7F]")


def is_valid_text(col) -> Column:
    return F.is_valid_utf8(_c(col))


def na_to_null(col) -> Column:
    """A dump cell equal to one of the NA spellings becomes NULL; others stay exact text."""
    c = _c(col)
    return F.when(~c.isin(*NA_TOKENS), c)
