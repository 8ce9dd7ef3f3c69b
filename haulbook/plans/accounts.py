"""One row per customer account or location."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulbook.functions import account_record_type, account_title, domain_list
from haulbook.operators.filters import live_rows
from haulbook.operators.joins import lookup_join
from haulbook.plans.layout import Out, format_own, same, select_layout

LAYOUT = [
    Out("pk", "account_external_id"),
    Out("parent_account_external_id", "parent_external_id"),
    Out("ultimate_parent_account_external_id", "root_account_external_id"),
    *same("account_external_id account_type"),
    Out("Name", "title"),
    *same("location_number"),
    Out("Address_Line_1__c", "location_address_line_1"),
    Out("Address_Line_2__c", "location_address_line_2"),
    Out("City__c", "location_city", "cut40"),
    Out("State__c", "location_state", "state"),
    Out("Zip_Code__c", "location_zip_code"),
    Out("CBSA__c", "location_cbsa_name"),
    Out("Latitude__c", "location_latitude", "round3"),
    Out("Longitude__c", "location_longitude", "round3"),
    Out("Location_First_Signup__c", "first_signup", "iso"),
    Out("Location_First_Ordered_At__c", "first_ordered_at", "iso"),
    Out("Location_First_Order_Booked_At__c", "first_order_booked_at", "iso"),
    Out("Location_Last_Ordered_At__c", "last_ordered_at", "iso"),
    Out("Location_Last_Order_Booked_At__c", "last_order_booked_at", "iso"),
    Out("Location_Pending_Invites__c", "pending_invites"),
    Out("Total_Revenue__c", "total_revenue_dollars"),
    Out("Total_Hotshot_Revenue__c", "hotshot_revenue_dollars"),
    Out("Total_Route_Revenue__c", "route_revenue_dollars"),
    Out("Total_CMS_Revenue__c", "cms_revenue_dollars"),
    *same("total_orders"),
    Out("Total_Hotshot_Orders__c", "hotshot_orders"),
    Out("Total_Route_Orders__c", "route_orders"),
    Out("Total_CMS_Orders__c", "cms_orders"),
    Out("Box_Trucks__c", "box_truck_score", "round2"),
    Out("Cars_SUVs__c", "car_suv_score", "round2"),
    Out("Cargos_Sprinters__c", "cargo_sprinter_score", "round2"),
    Out("Open_Decks__c", "opendeck_score", "round2"),
    Out("Serviceability_Score__c", "overall_score", "round2"),
    Out("Tractor_Trailers__c", "tractor_score", "round2"),
    Out("Trucks__c", "truck_score", "round2"),
    Out("Box_Trucks_Grade__c", "box_truck_grade"),
    Out("Cars_SUVs_Grade__c", "car_suv_grade"),
    Out("Cargos_Sprinters_Grade__c", "cargo_sprinter_grade"),
    Out("Open_Decks_Grade__c", "opendeck_grade"),
    Out("Serviceability_Grade__c", "overall_grade"),
    Out("Tractor_Trailers_Grade__c", "tractor_grade"),
    Out("Trucks_Grade__c", "truck_grade"),
    Out("Churn_Priority_Score__c", "priority_score"),
    Out("Churn_Revenue_Last_90_Days__c", "revenue_last_90_days"),
    Out("Churn_Revenue_Prior_90_Day_Period__c", "revenue_prior_90_days"),
    Out("Percent_Revenue_Change_Last_90_Prior_90__c", "pct_change_last90_vs_prior90"),
    Out("Delta_Unique_Users_Last_30_v_Prior_30__c", "delta_unique_users_last30_vs_prior30"),
    *same("potential_supply_issue", "or_false"),
    Out("account_record_type", "record_type"),
    *same("losing_account_external_ids"),
    Out("domain_list", "domain_list"),
]
KEPT = "account_id account_external_id account_type account_name company location_zip_code".split()


def live_parents(accounts: DataFrame) -> DataFrame:
    """(account_id, parent_external_id) of live accounts; the parent must be live too, else null.

    One parent may own a large share of all accounts, so its children are spread out.
    """
    live = live_rows(accounts)
    children = live.select(F.col("id").alias("account_id"), "parent_account_id")
    parents = live.select(F.col("id").alias("parent_account_id"), F.col("external_id").alias("parent_external_id"))
    joined = lookup_join(children, parents, ["parent_account_id"], ["account_id"])
    return joined.select("account_id", "parent_external_id")


def account_domains(accounts: DataFrame) -> DataFrame:
    """Readable e-mail domains of every account, deleted or not."""
    return accounts.select(F.col("id").alias("account_id"), domain_list(F.col("account_regex")).alias("domain_list"))


def with_parent(profiles: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add ``parent_external_id`` to account profiles."""
    parents = live_parents(accounts)
    return lookup_join(profiles, parents, ["account_id"], ["account_external_id"])


def with_serviceability(profiles: DataFrame, serviceability: DataFrame) -> DataFrame:
    """Add scores and grades of the zip code; a zip listed twice repeats the row."""
    measures = [c for c in serviceability.columns if c != "zip_code"]
    zips = serviceability.select(F.col("zip_code").alias("location_zip_code"), *measures)
    return lookup_join(profiles, zips, ["location_zip_code"], ["account_external_id"])


def with_churn_risk(profiles: DataFrame, churn_risk: DataFrame) -> DataFrame:
    return lookup_join(profiles, churn_risk, ["account_external_id"], ["account_id"])


def accounts_model(tables: Mapping[str, DataFrame]) -> DataFrame:
    """52 columns per live account profile; repeated rows removed; ordered by ``pk``."""
    profiles, accounts = live_rows(tables["account_profiles"]), tables["accounts"]
    own = format_own(profiles, LAYOUT, KEPT)

    # Parent and domains hang on the same id: join them to each other (narrow) and to the wide
    # profiles once.
    lineage = lookup_join(
        account_domains(accounts).distinct(), live_parents(accounts).distinct(), ["account_id"], ["domain_list"]
    )
    wide = lookup_join(own, lineage, ["account_id"], ["account_external_id"])
    wide = with_serviceability(wide, tables["serviceability"])
    wide = with_churn_risk(wide, tables["churn_risk"])

    family = F.col("account_type"), F.col("parent_external_id")
    finished = wide.withColumns(
        {
            "title": account_title(F.col("account_name"), F.col("company"), *family),
            "record_type": account_record_type(*family),
        }
    )
    result = select_layout(finished, LAYOUT).distinct()
    # The row hash only breaks ties: it lets range partitioning split a pk that has very many rows.
    return result.orderBy(F.col("pk").asc_nulls_last(), F.xxhash64(*result.columns))
