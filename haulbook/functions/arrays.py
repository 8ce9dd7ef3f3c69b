"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ";"


def list_text(values: Column) -> Column:
    """Array to ``;``-separated text in array order; null elements are skipped, null stays null."""
    return F.array_join(values, SEPARATOR)


def contains_value(values: Column, wanted: str) -> Column:
    """Two-valued membership test: a null array, or null elements without a match, is false."""
    return F.coalesce(F.array_contains(values, wanted), F.lit(False))


def matches_any(values: Column, pattern: str) -> Column:
    """Whether any element matches a case-insensitive LIKE pattern; false for a null array."""
    return F.coalesce(F.exists(values, lambda v: F.coalesce(v.ilike(pattern), F.lit(False))), F.lit(False))
