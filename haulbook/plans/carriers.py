"""One row per carrier and owner, with the 30-day scorecard."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulbook.operators.activity import active_entities
from haulbook.operators.filters import not_blank
from haulbook.operators.joins import fanout_join, lookup_join
from haulbook.operators.scorecard import CARRIER, scorecard, scorecard_columns
from haulbook.plans.layout import Out, format_own, same, select_layout, with_counts

LAYOUT = [
    Out("pk", "external_id"),
    Out("Name", "name"),
    Out("Carrier_External_ID__c", "external_id"),
    *same("driver_external_id"),
    Out("email_address", "email_address", "text"),
    *same("denial_context"),
    Out("Phone", "phone_number", "phone"),
    *same("note activity_level_status activity_level status"),
    *same("preferences", "list"),
    *same(
        """approved_on created_at last_request_sent last_request_accepted last_delivery_assignment
        last_delivery_completed_at last_hotshot_completed_at last_msd_completed_at last_route_completed_at""",
        "iso",
    ),
    *same("team_driver_count team_vehicle_count team_member_zips zips_with_complete_orders"),
    *same(
        """team_box_truck_count team_box_truck_with_liftgate_count team_box_truck_with_ramp_count
        team_box_truck_with_liftgate_and_ramp_count team_car_count team_cargo_van_count
        team_cargo_van_high_roof_count team_flatbed_count team_rack_vehicle_count team_stakebed_count
        team_stakebed_with_liftgate_and_ramp_count team_stakebed_with_liftgate_count
        team_stakebed_with_ramp_count team_suv_count team_trailer_count team_truck_count"""
    ),
    *same("total_orders total_hotshots total_msds total_routes address_line_1 city"),
    Out("State__c", "state", "state"),
    *same("zip_code zcta"),
    Out("CBSA__c", "cbsa_name"),
    *same("major_region dot mc ia phmsa stripe_account_id stripe_default_payout_account email_notifications_enabled"),
    *same("has_app_installed", "or_false"),
    *same(
        """has_insurance has_vehicles_without_photos is_fleets_approved is_vetted motor_cargo_coverage
        occupational_accident_coverage workers_compensation_coverage stripe_payouts_enabled"""
    ),
    *with_counts(scorecard_columns(CARRIER)),
]
KEPT = ["external_id", "email_address"]
PAIR = ["_id", "_mail", "_id_null", "_mail_null"]


def named_carriers(carriers: DataFrame) -> DataFrame:
    return carriers.filter(not_blank(F.col("name"), "", " "))


def with_owner(carriers: DataFrame, drivers: DataFrame) -> DataFrame:
    """Add ``driver_external_id`` of every owner with the carrier's e-mail; several owners repeat the row."""
    owners = drivers.filter(F.col("carrier_permissions") == "owner").select(
        "email_address", F.col("carrier_external_id").alias("external_id"), "driver_external_id"
    )
    return fanout_join(carriers, owners, ["email_address", "external_id"], ["external_id"])


def _paired(df: DataFrame) -> DataFrame:
    """Id and e-mail as columns without nulls, so that rows with a null one meet as well."""
    pair = {"_id": "external_id", "_mail": "email_address"}
    columns = {k: F.coalesce(F.col(c), F.lit("")) for k, c in pair.items()}
    return df.withColumns(columns | {f"{k}_null": F.col(c).isNull() for k, c in pair.items()})


def carriers_model(tables: Mapping[str, DataFrame], as_of=None, days: int = 30) -> DataFrame:
    """79 columns. A carrier repeats per owner, and per name it was recently active under.

    Metrics, names and owners meet on narrow tables of the distinct ids and e-mails; the wide carrier rows
    are shuffled once, to join all of it.
    """
    carriers = named_carriers(tables["carriers"])
    deliveries, violations = tables["deliveries"], tables["violations"]

    ids = carriers.select("external_id").dropna().distinct()
    active = active_entities(deliveries, violations, as_of=as_of, days=days)
    metrics = scorecard(ids, "external_id", deliveries, violations, tables["etas"], as_of=as_of, days=days).join(
        active.select(F.col(CARRIER).alias("external_id")), "external_id", "left"
    )
    own = format_own(carriers, LAYOUT, KEPT)
    owned = with_owner(carriers.select(*KEPT).distinct(), tables["drivers"])
    facts = lookup_join(owned, metrics, ["external_id"], ["email_address"])
    wide = lookup_join(_paired(own), _paired(facts).drop(*KEPT), PAIR, KEPT, "inner")  # every carrier has its pair there
    return select_layout(wide, LAYOUT)
