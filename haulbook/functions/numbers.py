"""Exact percentages and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_percent(part: Column, whole: Column) -> Column:
    """``part / whole`` as a percentage with two decimals; null when ``whole`` is zero or null.

    The warehouse divides whole numbers to six decimals, rounds half up there, and only then scales
    to a percentage and rounds to two. Doing both steps in whole numbers gives the same digits
    everywhere; a plain double division differs from about one pair in three hundred. The whole
    numbers are decimals, so any BIGINT counts will do.
    """
    n, d = part.cast("decimal(20,0)"), F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint")).cast("decimal(20,0)")
    two_million, two = F.lit(2_000_000).cast("decimal(7,0)"), F.lit(2).cast("decimal(1,0)")
    millionths = F.call_function("div", n * two_million + d, d * two)
    hundredths = F.call_function("div", millionths + 50, F.lit(100).cast("bigint"))
    return hundredths.cast("double") / 100.0


def rounded(value: Column, places: int) -> Column:
    """Round half away from zero on the shortest decimal digits of the double: 0.145 becomes 0.15."""
    return F.round(value, places)
