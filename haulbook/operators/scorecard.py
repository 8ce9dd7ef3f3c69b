"""30-day performance scorecard of a carrier or a driver.

Each metric is aggregated on its own before it is joined, so the joins see one row per entity. The
two joins between fact tables are on delivery ids, with a table of one row per id, which keeps a repeated id from
multiplying rows; a hot id can be split, or its rows are counted before they move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulbook.functions import exact_percent, rounded
from haulbook.operators.filters import (
    ACCURACY_VIOLATIONS,
    COMPLETION_VIOLATIONS,
    completed,
    in_lookback,
    scored_deliveries,
)
from haulbook.operators.joins import lookup_join
from haulbook.operators.members import possible_members

CARRIER = "carrier_external_id"
DRIVER = "driver_external_id"

# Minutes early (negative) or late that still count as on time, in seconds.
PICKUP_ON_TIME = (-30 * 60, 27 * 60)
DROPOFF_ON_TIME = (-30 * 60, 12 * 60)


def finished_deliveries(deliveries: DataFrame, entity: str) -> DataFrame:
    """Completed, scored deliveries of known entities, all time."""
    return completed(scored_deliveries(deliveries)).filter(F.col(entity).isNotNull())


def completions(deliveries: DataFrame, violations: DataFrame, entity: str = CARRIER, as_of=None, days: int = 30):
    """Completed deliveries in the window and how many of them had no accuracy violation.

    A violation counts against every carrier and driver of its delivery. Deliveries without an id
    match nothing and count as accurate. Carriers also get their number of distinct drivers.
    """
    by = [entity, DRIVER] if entity == CARRIER else [entity]
    recent = in_lookback(finished_deliveries(deliveries, entity), as_of, days)
    rows = recent.select("delivery_external_id", *by)
    inaccurate = (
        in_lookback(scored_deliveries(violations), as_of, days)
        .filter(F.col("violation_type_code").isin(ACCURACY_VIOLATIONS))
        .select("delivery_external_id")
        .distinct()
        .withColumn("inaccurate", F.lit(True))
    )
    metrics = [
        F.count("*").alias("completed_deliveries"),
        F.count_if(F.col("inaccurate").isNull()).alias("accurate_deliveries"),
    ]
    if entity == CARRIER:
        metrics.append(F.count_distinct(DRIVER).alias("driver_count"))
    return lookup_join(rows, inaccurate, ["delivery_external_id"], by).groupBy(entity).agg(*metrics)


def distinct_drivers(deliveries: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Exact number of drivers with a completed delivery, per carrier."""
    recent = in_lookback(finished_deliveries(deliveries, CARRIER), as_of, days)
    return recent.groupBy(CARRIER).agg(F.count_distinct(DRIVER).alias("driver_count"))


def ratings(deliveries: DataFrame, entity: str = CARRIER) -> DataFrame:
    """Average and number of customer ratings over all time."""
    return (
        finished_deliveries(deliveries, entity)
        .groupBy(entity)
        .agg(
            F.avg("customer_rating").alias("avg_customer_rating"),
            F.count("customer_rating").alias("rated_deliveries"),
        )
    )


def completion_violations(violations: DataFrame, entity: str = CARRIER, as_of=None, days: int = 30) -> DataFrame:
    return (
        in_lookback(scored_deliveries(violations), as_of, days)
        .filter(F.col("violation_type_code").isin(COMPLETION_VIOLATIONS) & F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(F.count("*").alias("completion_violation_count"))
    )


def eta_counts(etas: DataFrame) -> DataFrame:
    """Rows, and those on time at either end, per delivery id."""
    return etas.groupBy("delivery_id").agg(
        F.count("*").alias("etas"),
        F.count_if(F.col("seconds_to_origin_delta").between(*PICKUP_ON_TIME)).alias("pickups"),
        F.count_if(F.col("seconds_to_destination_delta").between(*DROPOFF_ON_TIME)).alias("dropoffs"),
    )


def eta_matches(deliveries: DataFrame, etas: DataFrame, entity: str = CARRIER, as_of=None, days: int = 30) -> DataFrame:
    """The window's distinct pairs of delivery id and entity, how many rows each stands for, and the id's ETA counts.

    ETAs of other deliveries, which are nearly all of them, are left out in the scan's stage. The rest cross one exchange, by
    delivery id, for the aggregate and the join alike; none if they are bucketed by it. Rows of the window that repeat a pair are
    counted in their task, so a hot id sends a row per entity and task.
    """
    recent = in_lookback(finished_deliveries(deliveries, entity), as_of, days).filter(F.col("delivery_id").isNotNull())
    pairs = recent.groupBy("delivery_id", entity).agg(F.count("*").alias("rows"))
    return pairs.join(eta_counts(possible_members(etas, recent, "delivery_id")), "delivery_id")


def on_time(deliveries: DataFrame, etas: DataFrame, entity: str = CARRIER, as_of=None, days: int = 30) -> DataFrame:
    """Share of ETA rows picked up and dropped off on time, for completed deliveries in the window.

    An unknown delta counts in the denominator only. Rows that share a delivery id pair up, so each
    delivery adds the counts of its id; no pair is ever built.
    """
    known = eta_matches(deliveries, etas, entity, as_of, days)
    counts = known.groupBy(entity).agg(*[F.sum(F.col("rows") * F.col(c)).alias(c) for c in ("etas", "pickups", "dropoffs")])
    return counts.select(
        entity,
        F.col("etas").alias("eta_delivery_count"),
        exact_percent(F.col("pickups"), F.col("etas")).alias("pickup_ontime_pct"),
        exact_percent(F.col("dropoffs"), F.col("etas")).alias("dropoff_ontime_pct"),
    )


def completion_rate(done: Column, failed: Column) -> Column:
    return exact_percent(done, done + failed)


# Counts are zero for an entity without rows; rates and on-time figures are null.
# The column names.
CARRIER_CARD = {
    "scorecard_driver_count__c": True,
    "scorecard_completed_deliveries__c": True,
    "scorecard_completion_violations__c": True,
    "scorecard_completion_rate__c": False,
    "scorecard_accurate_deliveries__c": True,
    "scorecard_delivery_accuracy__c": False,
    "scorecard_avg_customer_rating__c": False,
    "scorecard_rated_deliveries__c": True,
    "scorecard_eta_delivery_count__c": False,
    "scorecard_pickup_ontime_percent__c": False,
    "scorecard_dropoff_ontime_percent__c": False,
}
DRIVER_CARD = {
    "scorecard_completed_deliveries__c": True,
    "scorecard_completion_violations__c": True,
    "scorecard_completion_rate__c": False,
    "scorecard_accurate_deliveries__c": True,
    "scorecard_delivery_accuracy__c": False,
    "scorecard_average_customer_rating__c": False,
    "scorecard_rated_deliveries__c": True,
    "scorecard_eta_delivery_count__c": False,
    "scorecard_pickup_ontime_percent__c": False,
    "scorecard_dropoff_ontime_percent__c": False,
}


def scorecard_columns(entity: str) -> dict[str, bool]:
    """Names of the scorecard columns in output order, and whether each is a count."""
    return dict(CARRIER_CARD if entity == CARRIER else DRIVER_CARD)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint"))


def scorecard(
    entities: DataFrame,
    key: str,
    deliveries: DataFrame,
    violations: DataFrame,
    etas: DataFrame,
    entity: str = CARRIER,
    as_of=None,
    days: int = 30,
) -> DataFrame:
    """Add the scorecard columns to ``entities`` (one row per ``key``).

    Missing counts are zero, rates without a denominator and on-time figures without data are null.
    All four aggregates are hashed on the entity already, so only ``entities`` may need to move.
    """
    parts = [
        completions(deliveries, violations, entity, as_of, days),
        ratings(deliveries, entity),
        completion_violations(violations, entity, as_of, days),
        on_time(deliveries, etas, entity, as_of, days),
    ]
    joined = entities
    for part in parts:
        metrics = [c for c in part.columns if c != entity]
        joined = joined.join(part.select(F.col(entity).alias(key), *metrics), key, "left")

    return joined.select(*entities.columns, *[c.alias(name) for name, c in _card(entity).items()])


def _card(entity: str) -> dict[str, Column]:
    """Scorecard columns over the joined aggregates."""
    done, failed = _or_zero("completed_deliveries"), _or_zero("completion_violation_count")
    accurate, rated = _or_zero("accurate_deliveries"), _or_zero("rated_deliveries")
    rating = F.when(rated > 0, rounded(F.col("avg_customer_rating"), 2))
    values = [
        done,
        failed,
        completion_rate(done, failed),
        accurate,
        exact_percent(accurate, done),
        rating,
        rated,
        F.col("eta_delivery_count"),
        F.col("pickup_ontime_pct"),
        F.col("dropoff_ontime_pct"),
    ]
    if entity == CARRIER:
        values = [_or_zero("driver_count"), *values]
    return dict(zip(scorecard_columns(entity), values, strict=True))
