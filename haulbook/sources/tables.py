"""The input tables, their columns, and where results go."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns the models read, by type.
COLUMNS: dict[str, dict[str, list[str]]] = {
    "accounts": {
        "bigint": "id parent_account_id".split(),
        "boolean": ["is_deleted"],
        "string": "external_id account_regex".split(),
    },
    "account_profiles": {
        "bigint": "account_id pending_invites total_orders hotshot_orders route_orders cms_orders".split(),
        "boolean": ["is_deleted"],
        "double": """location_latitude location_longitude total_revenue_dollars hotshot_revenue_dollars
            route_revenue_dollars cms_revenue_dollars""".split(),
        "string": """account_external_id root_account_external_id account_type account_name company
            location_number location_address_line_1 location_address_line_2 location_city location_state
            location_zip_code location_cbsa_name losing_account_external_ids""".split(),
        "timestamp": """first_signup first_ordered_at first_order_booked_at last_ordered_at
            last_order_booked_at""".split(),
    },
    "serviceability": {
        "double": """box_truck_score car_suv_score cargo_sprinter_score opendeck_score overall_score
            tractor_score truck_score""".split(),
        "string": """zip_code box_truck_grade car_suv_grade cargo_sprinter_grade opendeck_grade overall_grade
            tractor_grade truck_grade""".split(),
    },
    "churn_risk": {
        "boolean": ["potential_supply_issue"],
        "double": """priority_score revenue_last_90_days revenue_prior_90_days pct_change_last90_vs_prior90
            delta_unique_users_last30_vs_prior30""".split(),
        "string": ["account_external_id"],
    },
    "carriers": {
        "array": ["preferences"],
        "bigint": """id team_driver_count team_vehicle_count team_box_truck_count
            team_box_truck_with_liftgate_count team_box_truck_with_ramp_count
            team_box_truck_with_liftgate_and_ramp_count team_car_count team_cargo_van_count
            team_cargo_van_high_roof_count team_flatbed_count team_rack_vehicle_count team_stakebed_count
            team_stakebed_with_liftgate_and_ramp_count team_stakebed_with_liftgate_count
            team_stakebed_with_ramp_count team_suv_count team_trailer_count team_truck_count total_orders
            total_hotshots total_msds total_routes""".split(),
        "boolean": """email_notifications_enabled has_app_installed has_insurance has_vehicles_without_photos
            is_fleets_approved is_vetted stripe_payouts_enabled""".split(),
        "string": """external_id name email_address denial_context phone_number note activity_level_status
            activity_level status team_member_zips zips_with_complete_orders address_line_1 city state zip_code
            zcta cbsa_name major_region dot mc ia phmsa stripe_account_id stripe_default_payout_account
            motor_cargo_coverage occupational_accident_coverage workers_compensation_coverage""".split(),
        "timestamp": """approved_on created_at last_request_sent last_request_accepted
            last_delivery_assignment last_delivery_completed_at last_hotshot_completed_at
            last_msd_completed_at last_route_completed_at""".split(),
    },
    "drivers": {
        "array": """driver_accessory_names driver_capability_names active_violation_types
            lifetime_violation_types driver_vehicle_accessory_names preferred_delivery_methods
            upscale_delivery_methods driver_tags""".split(),
        "bigint": """carrier_id total_bans active_violation_count lifetime_violation_count
            total_completed_deliveries total_hotshots_deliveries_completed total_route_deliveries_completed
            total_ratings total_customer_ratings total_internal_ratings scorecard_unassignments
            vehicle_year""".split(),
        "boolean": """has_active_violation is_dsp is_preferred_driver has_background_check_passed is_banned
            has_app_installed has_profile_photo went_through_carrier_flow""".split(),
        "double": """address_latitude address_longitude zip_code_latitude zip_code_longitude
            average_customer_rating average_internal_rating weighted_average_rating all_time_score
            on_time_destination_score on_time_origin_score on_time_score photos_score scorecard_score
            vehicle_cargo_capacity vehicle_max_payload vehicle_max_tow""".split(),
        "string": """driver_external_id carrier_external_id first_name last_name phone_number email_address
            activity_level_status activity_level status acquisition_source carrier_permissions
            driver_notification_preference driver_type checkr_invitation_status checkr_invitation_id
            first_checkr_invitation_id first_checkr_invitation_status first_background_check_approval
            first_background_check_rejection last_background_check_approval last_background_check_rejection
            checkr_candidate_id user_who_banned_driver_first user_who_banned_driver_last first_ban_reason
            last_ban_reason most_common_violation address_line_1 address_line_2 city state cbsa_name zip_code
            zcta major_region vehicle_teoalida_id vehicle_class vehicle_make vehicle_model
            vehicle_trim""".split(),
        "timestamp": """created_at carrier_approved_at carrier_created_at checkr_invitation_created_at
            checkr_invitation_completed_at first_checkr_invitation_created_at
            first_checkr_invitation_completed_at first_banned_at last_banned_at first_violation_created_at
            last_violation_created_at address_created_at last_request_sent last_request_accepted
            last_request_viewed first_delivery_completed_at third_delivery_completed_at
            fifth_delivery_completed_at last_delivery_completed_at last_hotshot_completed_at
            last_route_completed_at last_delivery_assignment""".split(),
    },
    "deliveries": {
        "bigint": ["delivery_id"],
        "boolean": ["is_completed_delivery"],
        "double": ["customer_rating"],
        "string": """delivery_external_id carrier_external_id carrier_name driver_external_id driver_name
            delivery_type""".split(),
        "timestamp": ["created_at"],
    },
    "violations": {
        "string": """delivery_external_id carrier_external_id carrier_name driver_external_id driver_name
            delivery_type violation_type_code""".split(),
        "timestamp": ["created_at"],
    },
    "etas": {"bigint": "delivery_id seconds_to_origin_delta seconds_to_destination_delta".split()},
    "routes": {"bigint": "route_template_id driver_id carrier_id".split(), "date": ["fulfilled_on"]},
    "route_templates": {"bigint": ["id"], "string": ["external_id"]},
    "route_drivers": {"bigint": ["driver_id"], "string": ["driver_external_id"]},
    "email_exclusions": {"string": ["email_address"]},
}


def column_names(table: str) -> list[str]:
    return [c for columns in COLUMNS[table].values() for c in columns]


def missing_columns(tables: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Columns the models need that the given tables lack (names compare case-insensitively)."""
    gaps = {}
    for table, df in tables.items():
        have = {c.lower() for c in df.columns}
        gaps[table] = [c for c in column_names(table) if c not in have]
    return {table: gap for table, gap in gaps.items() if gap}


def load_tables(spark: SparkSession, names: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Open input tables: a value with a slash is a path to ``fmt`` files, any other a catalog name."""
    return {
        table: spark.read.format(fmt).load(where) if "/" in where else spark.table(where)
        for table, where in names.items()
    }


def write_facts(df: DataFrame, path: str, by: str = "created_at", day: str = "created_on", fmt: str = "parquet") -> None:
    """Facts in one folder per day of ``by``, for lookback windows that read their days only. One task writes a day's part of its
    rows; give the table in order of ``by``, or few files per day will not hold."""
    df.withColumn(day, F.to_date(by)).write.partitionBy(day).format(fmt).save(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None, fmt: str = "parquet") -> None:
    """Facts as a catalog table bucketed and sorted by ``key``: aggregates and joins by it need no exchange.

    Deliveries and violations go by the entity that is scored, ETAs by ``delivery_id``. Rows are dealt by ``key`` first, so that a
    bucket is one file. A key that holds a large share of the rows makes a large bucket: bucket by a key without such.
    """
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format(fmt)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_model(model: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Hand a finished model to the sync job as files; a rerun replaces the previous result."""
    model.write.mode("overwrite").format(fmt).save(path)
