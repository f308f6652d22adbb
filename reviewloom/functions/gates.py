"""Row gates: predicates that decide whether a text is worth keeping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "no review".
PLACEHOLDERS = ("null", "none", "nan", "n/a")


def is_present(c: Column) -> Column:
    return c.isNotNull()


def is_not_blank(c: Column) -> Column:
    """Not empty after removing spaces (U+0020 only); NULL for NULL."""
    return F.length(F.trim(c)) > 0


def is_not_placeholder(c: Column) -> Column:
    """Case-blind and trimmed comparison with PLACEHOLDERS; NULL for NULL."""
    return ~F.lower(F.trim(c)).isin(*PLACEHOLDERS)


def passes_quality(c: Column) -> Column:
    return is_present(c) & is_not_blank(c) & is_not_placeholder(c)
