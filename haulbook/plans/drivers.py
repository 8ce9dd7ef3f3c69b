"""Exactly one row per driver, with the 30-day scorecard."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulbook.functions import contains_value, matches_any
from haulbook.operators.filters import not_blank, without_listed
from haulbook.operators.joins import exists_flag, fresh
from haulbook.operators.latest import latest_wide_rows, row_mark
from haulbook.operators.lists import array_list_columns
from haulbook.operators.routes import active_route_drivers, route_drivers
from haulbook.operators.scorecard import DRIVER, scorecard, scorecard_columns
from haulbook.plans.layout import Out, made, same, select_layout, with_counts

CERTIFIED_TAG = "ppe-certified"
PPE_ACCESSORY = "%(PPE)%"

# input array -> output list column
LISTS = {
    "driver_accessory_names": "Driver_Accessories__c",
    "driver_capability_names": "Driver_Capabilities__c",
    "active_violation_types": "Active_Violation_Types__c",
    "lifetime_violation_types": "Lifetime_Violation_types__c",
    "driver_vehicle_accessory_names": "Vehicle_Accessories__c",
    "preferred_delivery_methods": "Preferred_Delivery_Methods__c",
    "upscale_delivery_methods": "Upscale_Delivery_Methods__c",
}
LAYOUT = [
    Out("pk", "driver_external_id"),
    Out("FirstName", "first_name", "cut40"),
    Out("LastName", "last_name", "cut40"),
    *same("driver_external_id carrier_external_id route_template_id"),
    Out("Phone", "phone_number", "phone"),
    Out("Email", "email_address", "email"),
    *same("activity_level_status activity_level active_route_driver status has_active_violation"),
    *same("acquisition_source carrier_permissions"),
    Out("Is_Carrier__c", "carrier_id", "known"),
    *same("driver_notification_preference driver_type is_dsp is_preferred_driver"),
    *same("is_route_driver", "or_false"),
    *same("checkr_invitation_status"),
    *same(
        """created_at carrier_approved_at carrier_created_at checkr_invitation_created_at
        checkr_invitation_completed_at first_checkr_invitation_created_at first_checkr_invitation_completed_at""",
        "iso",
    ),
    Out("First_Banned_at__c", "first_banned_at", "iso"),
    *same(
        """last_banned_at first_violation_created_at last_violation_created_at address_created_at
        last_request_sent last_request_accepted last_request_viewed first_delivery_completed_at
        third_delivery_completed_at fifth_delivery_completed_at last_delivery_completed_at
        last_hotshot_completed_at last_route_completed_at last_delivery_assignment""",
        "iso",
    ),
    *same(
        """checkr_invitation_id first_checkr_invitation_id first_checkr_invitation_status
        first_background_check_approval first_background_check_rejection last_background_check_approval
        last_background_check_rejection has_background_check_passed checkr_candidate_id"""
    ),
    *same("total_bans user_who_banned_driver_first user_who_banned_driver_last first_ban_reason"),
    *same("last_ban_reason is_banned active_violation_count lifetime_violation_count most_common_violation"),
    *same("address_line_1 address_line_2"),
    Out("City__c", "city", "cut40"),
    Out("State__c", "state", "state"),
    Out("CBSA__c", "cbsa_name"),
    *same("zip_code zcta major_region"),
    Out("Latitude__c", "address_latitude"),
    Out("Longitude__c", "address_longitude"),
    *same("zip_code_latitude zip_code_longitude total_completed_deliveries"),
    Out("Total_Hotshot_Deliveries_Completed__c", "total_hotshots_deliveries_completed"),
    *same("total_route_deliveries_completed total_ratings total_customer_ratings total_internal_ratings"),
    *same("average_customer_rating average_internal_rating weighted_average_rating all_time_score"),
    *same("on_time_destination_score on_time_origin_score on_time_score photos_score scorecard_score"),
    *same("scorecard_unassignments vehicle_cargo_capacity vehicle_max_payload"),
    Out("Vehicle_Max_tow__c", "vehicle_max_tow"),
    *same("vehicle_teoalida_id vehicle_year vehicle_class vehicle_make vehicle_model vehicle_trim"),
    *with_counts(scorecard_columns(DRIVER)),
    *same("has_app_installed has_profile_photo went_through_carrier_flow"),
    Out("contact_record_type", "contact_record_type"),
    *made(" ".join(LISTS.values())),
    Out("PPE_certification", "certification"),
]
KEPT = ["driver_external_id", "last_request_viewed", "driver_tags"]


def admitted_drivers(drivers: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Named drivers with a phone that is not marked deleted and an e-mail that is not listed."""
    named = not_blank(F.col("first_name")) & not_blank(F.col("last_name"))
    kept = drivers.filter(named & ~F.col("phone_number").like("%del%"))
    return without_listed(kept, exclusions, "email_address")


def ppe_certification(tags: Column, has_ppe: Column) -> Column:
    return (
        F.when(contains_value(tags, CERTIFIED_TAG), "Certified").when(has_ppe, "Unverified").otherwise("None")
    )


def equipped_drivers(drivers: DataFrame) -> DataFrame:
    """Rows that list a PPE accessory."""
    return drivers.filter(matches_any(F.col("driver_accessory_names"), PPE_ACCESSORY))


def driver_facts(tables: Mapping[str, DataFrame], as_of=None, days: int = 30) -> DataFrame:
    """Everything computed per driver id, on a narrow table: scorecard, routes, lists, PPE flag."""
    drivers, routes = tables["drivers"], tables["routes"]
    ids = drivers.select(DRIVER).dropna().distinct()
    active = active_route_drivers(routes, tables["route_templates"], tables["route_drivers"], as_of)
    facts = scorecard(
        ids, DRIVER, tables["deliveries"], tables["violations"], tables["etas"], DRIVER, as_of=as_of, days=days
    )
    active = active.select(DRIVER, "route_template_id", F.col("active").alias("active_route_driver"))
    facts = facts.join(active, DRIVER, "left")
    facts = exists_flag(facts, route_drivers(routes, tables["route_drivers"]), DRIVER, "is_route_driver")
    facts = exists_flag(facts, equipped_drivers(drivers), DRIVER, "has_ppe")
    return facts.join(array_list_columns(drivers, DRIVER, LISTS), DRIVER, "left")


def drivers_model(tables: Mapping[str, DataFrame], as_of=None, days: int = 30) -> DataFrame:
    """121 columns, one row per driver, ordered by ``pk``.

    Picking the latest row needs driver columns only, as they are stored, and ranks rows of three columns. All facts are
    brought together on driver ids first and join that pick; the wide rows then pass one join, which keeps those that were
    picked. Columns are formatted last, above the final order: once per row of the result, in a stage that the
    sampling for that order does not run. Recent activity would contribute no column, and the pick would undo its
    repeats, so it is not read.
    """
    drivers = tables["drivers"]
    needed = [c for c in dict.fromkeys([*KEPT, *(out.source for out in LAYOUT)]) if c in drivers.columns]
    mark = fresh("mark", drivers)
    marked = drivers.select(*needed, row_mark(needed).alias(mark))
    admitted = admitted_drivers(marked, tables["email_exclusions"])
    picked = latest_wide_rows(admitted, DRIVER, "last_request_viewed", mark, driver_facts(tables, as_of, days))
    wide = picked.withColumns(
        {
            "certification": ppe_certification(F.col("driver_tags"), F.col("has_ppe")),
            "contact_record_type": F.lit("Driver"),
        }
    )
    return select_layout(wide.orderBy(F.col(DRIVER).asc_nulls_last()), LAYOUT)
