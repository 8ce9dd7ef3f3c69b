"""Row admission rules. Every one is a plain predicate that Catalyst can push to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulbook.functions import days_before

# Delivery types and violation codes the scorecards are defined on.
EXCLUDED_DELIVERY_TYPES = ["route", "cms"]
ACCURACY_VIOLATIONS = [
    "did_not_follow_delivery_instructions",
    "wrong_vehicle",
    "confirmed_wrong_vehicle",
    "wrong_accessories",
    "did_not_deliver_all_items",
]
COMPLETION_VIOLATIONS = [
    "self_unassignment",
    "scheduled_delivery_failure",
    "did_not_complete_multistop_delivery",
]


PARTITION_DAY = "created_on"  # optional date column of deliveries and violations, see sources.write_facts


def scored_deliveries(df: DataFrame) -> DataFrame:
    """Drop route and cms work; an unknown (null) type is dropped too."""
    return df.filter(~F.col("delivery_type").isin(EXCLUDED_DELIVERY_TYPES))


def in_lookback(
    df: DataFrame, as_of=None, days: int = 30, column: str = "created_at", day: str = PARTITION_DAY
) -> DataFrame:
    """Rows from midnight ``days`` before ``as_of`` onwards; there is no upper bound.

    If the table has the column ``day``, the date of ``column`` in any time zone, by which facts are partitioned, it gets a bound as
    well, so that only the window's folders are listed and read. The bound is two days wider: dates of one instant differ by
    up to two between zones. Rows without a date have no ``column`` either and are in no window.
    """
    recent = df.filter(F.col(column) >= days_before(as_of, days))
    return recent.filter(F.col(day) >= days_before(as_of, days + 2)) if day in df.columns else recent


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_completed_delivery"))


def live_rows(df: DataFrame) -> DataFrame:
    """Soft delete: unknown counts as not deleted."""
    return df.filter(~F.coalesce(F.col("is_deleted"), F.lit(False)))


def not_blank(column: Column, *blanks: str) -> Column:
    """Neither null nor one of the given blank spellings (the empty string by default)."""
    return column.isNotNull() & ~column.isin(*(blanks or ("",)))


def without_listed(df: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is known and not in a list held as a table.

    A null in the list is no address and excludes nothing, where SQL's NOT IN would return no row at all.
    The list is compared as stored (case and spaces count). It is broadcast only if Spark finds it
    below ``spark.sql.autoBroadcastJoinThreshold``; a longer list becomes a shuffled anti join.
    """
    return df.filter(F.col(column).isNotNull()).join(listed.select(column), column, "left_anti")
