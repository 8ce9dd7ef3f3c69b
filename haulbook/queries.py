"""Registered queries: each operator and model on the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulbook import functions as fx
from haulbook.operators import filters, scorecard
from haulbook.operators.activity import active_drivers, active_entities
from haulbook.operators.joins import exists_flag
from haulbook.operators.latest import latest_per_key
from haulbook.operators.lists import array_list_columns, listagg_distinct, tag_rows
from haulbook.operators.routes import active_route_drivers, route_drivers, route_history
from haulbook.plans import accounts_model, carriers_model, drivers_model
from haulbook.plans.accounts import account_domains, with_churn_risk, with_parent, with_serviceability
from haulbook.plans.carriers import named_carriers, with_owner
from haulbook.plans.drivers import LISTS, PPE_ACCESSORY, equipped_drivers
from haulbook.plans.drivers import ppe_certification as certification
from haulbook.sources.sample import AS_OF, SampleTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CARRIER, DRIVER = scorecard.CARRIER, scorecard.DRIVER


def on(*tables: str):
    """Register a query under its function name (a trailing underscore only avoids a clash with the
    operator it runs); it receives the sample tables it names."""

    def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            sample = SampleTables(spark, sf_dir)
            return build(*[sample[t] for t in tables])

        QUERIES[build.__name__.rstrip("_")] = run
        return build

    return register


# --- scorecard ----------------------------------------------------------------------------------


@on("deliveries")
def rolling_lookback(deliveries):
    return filters.in_lookback(deliveries, AS_OF).groupBy("delivery_type").agg(F.count("*").alias("rows_in_window"))


@on("deliveries", "violations")
def accurate_deliveries(deliveries, violations):
    done = scorecard.completions(deliveries, violations, as_of=AS_OF)
    return done.select(CARRIER, "completed_deliveries", "accurate_deliveries")


@on("deliveries")
def distinct_driver_count(deliveries):
    return scorecard.distinct_drivers(deliveries, AS_OF)


@on("deliveries")
def entity_ratings(deliveries):
    return scorecard.ratings(deliveries)


@on("violations")
def completion_violations(violations):
    return scorecard.completion_violations(violations, as_of=AS_OF)


@on("deliveries", "etas")
def eta_ontime(deliveries, etas):
    return scorecard.on_time(deliveries, etas, as_of=AS_OF)


@on("deliveries", "violations")
def scorecard_rates(deliveries, violations):
    done = scorecard.completions(deliveries, violations, as_of=AS_OF)
    both = done.join(scorecard.completion_violations(violations, as_of=AS_OF), CARRIER, "full").fillna(0)
    n, failed = F.col("completed_deliveries"), F.col("completion_violation_count")
    return both.select(
        CARRIER,
        scorecard.completion_rate(n, failed).alias("completion_rate"),
        fx.exact_percent(F.col("accurate_deliveries"), n).alias("delivery_accuracy"),
    )


@on("carriers", "deliveries", "violations", "etas")
def carrier_scorecard(carriers, deliveries, violations, etas):
    ids = carriers.select("external_id").distinct()
    return scorecard.scorecard(ids, "external_id", deliveries, violations, etas, as_of=AS_OF)


@on("drivers", "deliveries", "violations", "etas")
def driver_scorecard(drivers, deliveries, violations, etas):
    ids = drivers.select(DRIVER).distinct()
    return scorecard.scorecard(ids, DRIVER, deliveries, violations, etas, DRIVER, as_of=AS_OF)


# --- activity -----------------------------------------------------------------------------------


@on("deliveries", "violations")
def active_entities_(deliveries, violations):
    return active_entities(deliveries, violations, as_of=AS_OF)


@on("deliveries", "violations")
def active_drivers_(deliveries, violations):
    return active_drivers(deliveries, violations, AS_OF)


@on("carriers", "deliveries", "violations")
def active_entities_fanout(carriers, deliveries, violations):
    active = active_entities(deliveries, violations, as_of=AS_OF).withColumnRenamed(CARRIER, "external_id")
    rows = carriers.groupBy("external_id").agg(F.count("*").alias("rows"))
    names = active.groupBy("external_id").agg(F.count("*").alias("names"))
    copies = F.col("rows") * F.coalesce(F.col("names"), F.lit(1))
    return rows.join(names, "external_id", "left").select("external_id", copies.alias("copies"))


# --- column rules -------------------------------------------------------------------------------


@on("account_profiles")
def state_code(profiles):
    return profiles.select("account_id", fx.state_code(F.col("location_state")).alias("state_code"))


@on("drivers")
def phone_normalize(drivers):
    return drivers.select(DRIVER, "phone_number", fx.phone_normalize(F.col("phone_number")).alias("phone"))


@on("drivers")
def email_normalize(drivers):
    return drivers.select(DRIVER, fx.email_normalize(F.col("email_address")).alias("email"))


@on("accounts")
def domain_list(accounts):
    return account_domains(accounts).withColumnRenamed("account_id", "id")


def _family(profiles, accounts) -> tuple[DataFrame, list]:
    parent = F.col("parent_external_id")
    return with_parent(profiles, accounts), [F.col("account_type"), parent]


@on("account_profiles", "accounts")
def account_name(profiles, accounts):
    df, family = _family(profiles, accounts)
    return df.select("account_id", fx.account_title(F.col("account_name"), F.col("company"), *family).alias("name"))


@on("account_profiles", "accounts")
def account_record_type(profiles, accounts):
    df, family = _family(profiles, accounts)
    return df.select("account_id", fx.account_record_type(*family).alias("account_record_type"))


def iso_utc_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", fx.iso_utc(F.col("ts")).alias("ts_iso"))


QUERIES["iso_utc_timestamp"] = iso_utc_timestamp


@on("account_profiles", "serviceability")
def round_measures(profiles, serviceability):
    return with_serviceability(profiles, serviceability).select(
        "account_id",
        fx.rounded(F.col("location_latitude"), 3).alias("latitude"),
        fx.rounded(F.col("overall_score"), 2).alias("overall_score"),
    )


@on("carriers")
def array_to_string(carriers):
    return carriers.select("external_id", fx.list_text(F.col("preferences")).alias("preferences"))


# --- row filters --------------------------------------------------------------------------------


@on("carriers")
def non_blank_filter(carriers):
    return named_carriers(carriers).select("external_id", "name")


@on("accounts")
def soft_delete_filter(accounts):
    return filters.live_rows(accounts).select("id")


@on("drivers", "email_exclusions")
def exclusion_list(drivers, email_exclusions):
    return filters.without_listed(drivers.select(DRIVER, "email_address"), email_exclusions, "email_address")


@on("deliveries")
def distinct_rows(deliveries):
    return deliveries.select(CARRIER, "delivery_type").distinct()


# --- joins --------------------------------------------------------------------------------------


@on("account_profiles", "serviceability", "churn_risk")
def dimension_enrich(profiles, serviceability, churn_risk):
    df = with_churn_risk(with_serviceability(profiles, serviceability), churn_risk)
    return df.select("account_id", F.col("location_zip_code").alias("zip_code"), "overall_grade", "priority_score")


@on("account_profiles", "accounts")
def parent_lookup(profiles, accounts):
    return with_parent(profiles, accounts).select("account_id", "parent_external_id")


@on("carriers", "drivers")
def composite_key_join(carriers, drivers):
    return with_owner(carriers, drivers).select("external_id", DRIVER)


@on("drivers", "routes", "route_drivers")
def existence_flag(drivers, routes, drivers_on_routes):
    drove = route_drivers(routes, drivers_on_routes)
    return exists_flag(drivers.select(DRIVER), drove, DRIVER, "is_route_driver", spread=[DRIVER])


# --- routes and latest rows ---------------------------------------------------------------------


@on("routes", "route_templates", "route_drivers", "carriers")
def route_templates(routes, templates, drivers, carriers):
    return route_history(routes, templates, drivers, carriers, AS_OF)


@on("routes", "route_templates", "route_drivers")
def active_route_driver(routes, templates, drivers):
    return active_route_drivers(routes, templates, drivers, AS_OF)


@on("drivers")
def latest_per_key_(drivers):
    columns = drivers.select(DRIVER, "last_request_viewed", "driver_accessory_csv")
    return latest_per_key(columns, DRIVER, "last_request_viewed")


# --- arrays -------------------------------------------------------------------------------------


@on("drivers")
def array_list_columns_(drivers):
    return array_list_columns(drivers, DRIVER, LISTS)


@on("deliveries")
def listagg_distinct_(deliveries):
    return listagg_distinct(deliveries, CARRIER, "delivery_type", "delivery_types")


@on("drivers")
def tag_rows_(drivers):
    return tag_rows(drivers, DRIVER, "driver_accessory_names", PPE_ACCESSORY, "accessory_name")


@on("drivers")
def ppe_certification(drivers):
    tagged = drivers.select(DRIVER, "driver_tags")
    flagged = exists_flag(tagged, equipped_drivers(drivers), DRIVER, "has_ppe", spread=["driver_tags"])
    verdict = certification(F.col("driver_tags"), F.col("has_ppe"))
    return flagged.select(DRIVER, verdict.alias("ppe_certification"))


# --- models -------------------------------------------------------------------------------------


def model(build: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: build(SampleTables(spark, sf_dir), *args)


QUERIES["accounts_model"] = model(accounts_model)
QUERIES["carriers_model"] = model(carriers_model, AS_OF)
QUERIES["drivers_model"] = model(drivers_model, AS_OF)
