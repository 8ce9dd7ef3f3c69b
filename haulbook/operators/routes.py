"""Route history and the drivers on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulbook.functions import days_before
from haulbook.operators.filters import in_lookback
from haulbook.operators.joins import lookup_join
from haulbook.operators.latest import latest_per_key

ACTIVE_DAYS = 7


def _template_ids(templates: DataFrame) -> DataFrame:
    return templates.select(F.col("id").alias("route_template_id"), F.col("external_id").alias("template")).distinct()


def _driver_ids(drivers: DataFrame) -> DataFrame:
    return drivers.select("driver_id", "driver_external_id").distinct()


def route_history(
    routes: DataFrame,
    templates: DataFrame,
    drivers: DataFrame,
    carriers: DataFrame,
    as_of=None,
    days: int = ACTIVE_DAYS,
) -> DataFrame:
    """Distinct (driver, carrier, template, date, active flag); unknown ids give nulls.

    The result depends on the four route columns only, so repeated routes go before the joins. One
    template, driver or carrier may still be on a large share of the rest; its rows are spread out.
    """
    carrier_ids = carriers.select(F.col("id").alias("carrier_id"), F.col("external_id").alias("carrier")).distinct()
    runs = routes.select("route_template_id", "driver_id", "carrier_id", "fulfilled_on").distinct()
    named = runs
    lookups = {
        "route_template_id": _template_ids(templates),
        "driver_id": _driver_ids(drivers),
        "carrier_id": carrier_ids,
    }
    for key, lookup in lookups.items():
        spread = [c for c in runs.columns if c != key]
        named = lookup_join(named, lookup, [key], spread)
    return named.select(
        "driver_external_id",
        F.col("carrier").alias("carrier_id"),
        F.col("template").alias("route_template_id"),
        "fulfilled_on",
        (F.col("fulfilled_on") >= days_before(as_of, days)).alias("active"),
    ).distinct()


def active_route_drivers(
    routes: DataFrame, templates: DataFrame, drivers: DataFrame, as_of=None, days: int = ACTIVE_DAYS
) -> DataFrame:
    """Each driver's latest route template of the last days, with ``active`` = true.

    The date filter reaches the scan, and a driver's runs of one template shrink to their latest
    date before anything is joined or ranked. Same-day templates tie; the smallest id wins.
    """
    latest = (
        in_lookback(routes, as_of, days, "fulfilled_on")
        .groupBy("driver_id", "route_template_id")
        .agg(F.max("fulfilled_on").alias("fulfilled_on"))
    )
    named = lookup_join(latest, _template_ids(templates), ["route_template_id"], ["driver_id"])
    named = lookup_join(named, _driver_ids(drivers), ["driver_id"], ["route_template_id"])
    named = named.select("driver_external_id", F.col("template").alias("route_template_id"), "fulfilled_on")
    first = latest_per_key(named, "driver_external_id", "fulfilled_on", [F.col("route_template_id").asc_nulls_last()])
    return first.select("driver_external_id", "route_template_id", F.lit(True).alias("active"))


def route_drivers(routes: DataFrame, drivers: DataFrame) -> DataFrame:
    """Distinct drivers that ever had a route."""
    seen = routes.select("driver_id").dropna().distinct()
    return seen.join(_driver_ids(drivers), "driver_id").select("driver_external_id").distinct()
