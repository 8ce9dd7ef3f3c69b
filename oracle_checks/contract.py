"""What the three models promise: output column, input column, format. Fixed values, written out.

The pipelines derive many names by rule; this list does not, so that a wrong name, source or format shows.
"""

from __future__ import annotations


ACCOUNTS = [
    ("pk", "account_external_id", "copy"),
    ("parent_account_external_id", "parent_external_id", "copy"),
    ("ultimate_parent_account_external_id", "root_account_external_id", "copy"),
    ("Account_External_ID__c", "account_external_id", "copy"),
    ("Account_Type__c", "account_type", "copy"),
    ("Name", "title", "copy"),
    ("Location_Number__c", "location_number", "copy"),
    ("Address_Line_1__c", "location_address_line_1", "copy"),
    ("Address_Line_2__c", "location_address_line_2", "copy"),
    ("City__c", "location_city", "cut40"),
    ("State__c", "location_state", "state"),
    ("Zip_Code__c", "location_zip_code", "copy"),
    ("CBSA__c", "location_cbsa_name", "copy"),
    ("Latitude__c", "location_latitude", "round3"),
    ("Longitude__c", "location_longitude", "round3"),
    ("Location_First_Signup__c", "first_signup", "iso"),
    ("Location_First_Ordered_At__c", "first_ordered_at", "iso"),
    ("Location_First_Order_Booked_At__c", "first_order_booked_at", "iso"),
    ("Location_Last_Ordered_At__c", "last_ordered_at", "iso"),
    ("Location_Last_Order_Booked_At__c", "last_order_booked_at", "iso"),
    ("Location_Pending_Invites__c", "pending_invites", "copy"),
    ("Total_Revenue__c", "total_revenue_dollars", "copy"),
    ("Total_Hotshot_Revenue__c", "hotshot_revenue_dollars", "copy"),
    ("Total_Route_Revenue__c", "route_revenue_dollars", "copy"),
    ("Total_CMS_Revenue__c", "cms_revenue_dollars", "copy"),
    ("Total_Orders__c", "total_orders", "copy"),
    ("Total_Hotshot_Orders__c", "hotshot_orders", "copy"),
    ("Total_Route_Orders__c", "route_orders", "copy"),
    ("Total_CMS_Orders__c", "cms_orders", "copy"),
    ("Box_Trucks__c", "box_truck_score", "round2"),
    ("Cars_SUVs__c", "car_suv_score", "round2"),
    ("Cargos_Sprinters__c", "cargo_sprinter_score", "round2"),
    ("Open_Decks__c", "opendeck_score", "round2"),
    ("Serviceability_Score__c", "overall_score", "round2"),
    ("Tractor_Trailers__c", "tractor_score", "round2"),
    ("Trucks__c", "truck_score", "round2"),
    ("Box_Trucks_Grade__c", "box_truck_grade", "copy"),
    ("Cars_SUVs_Grade__c", "car_suv_grade", "copy"),
    ("Cargos_Sprinters_Grade__c", "cargo_sprinter_grade", "copy"),
    ("Open_Decks_Grade__c", "opendeck_grade", "copy"),
    ("Serviceability_Grade__c", "overall_grade", "copy"),
    ("Tractor_Trailers_Grade__c", "tractor_grade", "copy"),
    ("Trucks_Grade__c", "truck_grade", "copy"),
    ("Churn_Priority_Score__c", "priority_score", "copy"),
    ("Churn_Revenue_Last_90_Days__c", "revenue_last_90_days", "copy"),
    ("Churn_Revenue_Prior_90_Day_Period__c", "revenue_prior_90_days", "copy"),
    ("Percent_Revenue_Change_Last_90_Prior_90__c", "pct_change_last90_vs_prior90", "copy"),
    ("Delta_Unique_Users_Last_30_v_Prior_30__c", "delta_unique_users_last30_vs_prior30", "copy"),
    ("Potential_Supply_Issue__c", "potential_supply_issue", "or_false"),
    ("account_record_type", "record_type", "copy"),
    ("Losing_Account_External_Ids__c", "losing_account_external_ids", "copy"),
    ("domain_list", "domain_list", "copy"),
]

CARRIERS = [
    ("pk", "external_id", "copy"),
    ("Name", "name", "copy"),
    ("Carrier_External_ID__c", "external_id", "copy"),
    ("Driver_External_ID__c", "driver_external_id", "copy"),
    ("email_address", "email_address", "text"),
    ("Denial_Context__c", "denial_context", "copy"),
    ("Phone", "phone_number", "phone"),
    ("Note__c", "note", "copy"),
    ("Activity_Level_Status__c", "activity_level_status", "copy"),
    ("Activity_Level__c", "activity_level", "copy"),
    ("Status__c", "status", "copy"),
    ("Preferences__c", "preferences", "list"),
    ("Approved_On__c", "approved_on", "iso"),
    ("Created_At__c", "created_at", "iso"),
    ("Last_Request_Sent__c", "last_request_sent", "iso"),
    ("Last_Request_Accepted__c", "last_request_accepted", "iso"),
    ("Last_Delivery_Assignment__c", "last_delivery_assignment", "iso"),
    ("Last_Delivery_Completed_At__c", "last_delivery_completed_at", "iso"),
    ("Last_Hotshot_Completed_At__c", "last_hotshot_completed_at", "iso"),
    ("Last_MSD_Completed_At__c", "last_msd_completed_at", "iso"),
    ("Last_Route_Completed_At__c", "last_route_completed_at", "iso"),
    ("Team_Driver_Count__c", "team_driver_count", "copy"),
    ("Team_Vehicle_Count__c", "team_vehicle_count", "copy"),
    ("Team_Member_Zips__c", "team_member_zips", "copy"),
    ("Zips_with_Complete_Orders__c", "zips_with_complete_orders", "copy"),
    ("Team_Box_Truck_Count__c", "team_box_truck_count", "copy"),
    ("Team_Box_Truck_with_Liftgate_Count__c", "team_box_truck_with_liftgate_count", "copy"),
    ("Team_Box_Truck_with_Ramp_Count__c", "team_box_truck_with_ramp_count", "copy"),
    ("Team_Box_Truck_with_Liftgate_and_Ramp_Co__c", "team_box_truck_with_liftgate_and_ramp_count", "copy"),
    ("Team_Car_Count__c", "team_car_count", "copy"),
    ("Team_Cargo_Van_Count__c", "team_cargo_van_count", "copy"),
    ("Team_Cargo_Van_High_Roof_Count__c", "team_cargo_van_high_roof_count", "copy"),
    ("Team_Flatbed_Count__c", "team_flatbed_count", "copy"),
    ("Team_Rack_Vehicle_Count__c", "team_rack_vehicle_count", "copy"),
    ("Team_Stakebed_Count__c", "team_stakebed_count", "copy"),
    ("Team_Stakebed_with_Liftgate_and_Ramp_Cou__c", "team_stakebed_with_liftgate_and_ramp_count", "copy"),
    ("Team_Stakebed_with_Liftgate_Count__c", "team_stakebed_with_liftgate_count", "copy"),
    ("Team_Stakebed_with_Ramp_Count__c", "team_stakebed_with_ramp_count", "copy"),
    ("Team_SUV_Count__c", "team_suv_count", "copy"),
    ("Team_Trailer_Count__c", "team_trailer_count", "copy"),
    ("Team_Truck_Count__c", "team_truck_count", "copy"),
    ("Total_Orders__c", "total_orders", "copy"),
    ("Total_Hotshots__c", "total_hotshots", "copy"),
    ("Total_MSDs__c", "total_msds", "copy"),
    ("Total_Routes__c", "total_routes", "copy"),
    ("Address_Line_1__c", "address_line_1", "copy"),
    ("City__c", "city", "copy"),
    ("State__c", "state", "state"),
    ("Zip_Code__c", "zip_code", "copy"),
    ("ZCTA__c", "zcta", "copy"),
    ("CBSA__c", "cbsa_name", "copy"),
    ("Major_Region__c", "major_region", "copy"),
    ("DOT__c", "dot", "copy"),
    ("MC__c", "mc", "copy"),
    ("IA__c", "ia", "copy"),
    ("PHMSA__c", "phmsa", "copy"),
    ("Stripe_Account_ID__c", "stripe_account_id", "copy"),
    ("Stripe_Default_Payout_Account__c", "stripe_default_payout_account", "copy"),
    ("Email_Notifications_Enabled__c", "email_notifications_enabled", "copy"),
    ("Has_App_Installed__c", "has_app_installed", "or_false"),
    ("Has_Insurance__c", "has_insurance", "copy"),
    ("Has_Vehicles_Without_Photos__c", "has_vehicles_without_photos", "copy"),
    ("Is_Fleets_Approved__c", "is_fleets_approved", "copy"),
    ("Is_Vetted__c", "is_vetted", "copy"),
    ("Motor_Cargo_Coverage__c", "motor_cargo_coverage", "copy"),
    ("Occupational_Accident_Coverage__c", "occupational_accident_coverage", "copy"),
    ("Workers_Compensation_Coverage__c", "workers_compensation_coverage", "copy"),
    ("Stripe_Payouts_Enabled__c", "stripe_payouts_enabled", "copy"),
    ("scorecard_driver_count__c", "scorecard_driver_count__c", "or_zero"),
    ("scorecard_completed_deliveries__c", "scorecard_completed_deliveries__c", "or_zero"),
    ("scorecard_completion_violations__c", "scorecard_completion_violations__c", "or_zero"),
    ("scorecard_completion_rate__c", "scorecard_completion_rate__c", "copy"),
    ("scorecard_accurate_deliveries__c", "scorecard_accurate_deliveries__c", "or_zero"),
    ("scorecard_delivery_accuracy__c", "scorecard_delivery_accuracy__c", "copy"),
    ("scorecard_avg_customer_rating__c", "scorecard_avg_customer_rating__c", "copy"),
    ("scorecard_rated_deliveries__c", "scorecard_rated_deliveries__c", "or_zero"),
    ("scorecard_eta_delivery_count__c", "scorecard_eta_delivery_count__c", "copy"),
    ("scorecard_pickup_ontime_percent__c", "scorecard_pickup_ontime_percent__c", "copy"),
    ("scorecard_dropoff_ontime_percent__c", "scorecard_dropoff_ontime_percent__c", "copy"),
]

DRIVERS = [
    ("pk", "driver_external_id", "copy"),
    ("FirstName", "first_name", "cut40"),
    ("LastName", "last_name", "cut40"),
    ("Driver_External_ID__c", "driver_external_id", "copy"),
    ("Carrier_External_ID__c", "carrier_external_id", "copy"),
    ("Route_Template_ID__c", "route_template_id", "copy"),
    ("Phone", "phone_number", "phone"),
    ("Email", "email_address", "email"),
    ("Activity_Level_Status__c", "activity_level_status", "copy"),
    ("Activity_Level__c", "activity_level", "copy"),
    ("Active_Route_Driver__c", "active_route_driver", "copy"),
    ("Status__c", "status", "copy"),
    ("Has_Active_Violation__c", "has_active_violation", "copy"),
    ("Acquisition_Source__c", "acquisition_source", "copy"),
    ("Carrier_Permissions__c", "carrier_permissions", "copy"),
    ("Is_Carrier__c", "carrier_id", "known"),
    ("Driver_Notification_Preference__c", "driver_notification_preference", "copy"),
    ("Driver_Type__c", "driver_type", "copy"),
    ("Is_DSP__c", "is_dsp", "copy"),
    ("Is_Preferred_Driver__c", "is_preferred_driver", "copy"),
    ("Is_Route_Driver__c", "is_route_driver", "or_false"),
    ("Checkr_Invitation_Status__c", "checkr_invitation_status", "copy"),
    ("Created_At__c", "created_at", "iso"),
    ("Carrier_Approved_At__c", "carrier_approved_at", "iso"),
    ("Carrier_Created_At__c", "carrier_created_at", "iso"),
    ("Checkr_Invitation_Created_At__c", "checkr_invitation_created_at", "iso"),
    ("Checkr_Invitation_Completed_At__c", "checkr_invitation_completed_at", "iso"),
    ("First_Checkr_Invitation_Created_At__c", "first_checkr_invitation_created_at", "iso"),
    ("First_Checkr_Invitation_Completed_At__c", "first_checkr_invitation_completed_at", "iso"),
    ("First_Banned_at__c", "first_banned_at", "iso"),
    ("Last_Banned_At__c", "last_banned_at", "iso"),
    ("First_Violation_Created_At__c", "first_violation_created_at", "iso"),
    ("Last_Violation_Created_At__c", "last_violation_created_at", "iso"),
    ("Address_Created_At__c", "address_created_at", "iso"),
    ("Last_Request_Sent__c", "last_request_sent", "iso"),
    ("Last_Request_Accepted__c", "last_request_accepted", "iso"),
    ("Last_Request_Viewed__c", "last_request_viewed", "iso"),
    ("First_Delivery_Completed_At__c", "first_delivery_completed_at", "iso"),
    ("Third_Delivery_Completed_At__c", "third_delivery_completed_at", "iso"),
    ("Fifth_Delivery_Completed_At__c", "fifth_delivery_completed_at", "iso"),
    ("Last_Delivery_Completed_At__c", "last_delivery_completed_at", "iso"),
    ("Last_Hotshot_Completed_At__c", "last_hotshot_completed_at", "iso"),
    ("Last_Route_Completed_At__c", "last_route_completed_at", "iso"),
    ("Last_Delivery_Assignment__c", "last_delivery_assignment", "iso"),
    ("Checkr_Invitation_ID__c", "checkr_invitation_id", "copy"),
    ("First_Checkr_Invitation_ID__c", "first_checkr_invitation_id", "copy"),
    ("First_Checkr_Invitation_Status__c", "first_checkr_invitation_status", "copy"),
    ("First_Background_Check_Approval__c", "first_background_check_approval", "copy"),
    ("First_Background_Check_Rejection__c", "first_background_check_rejection", "copy"),
    ("Last_Background_Check_Approval__c", "last_background_check_approval", "copy"),
    ("Last_Background_Check_Rejection__c", "last_background_check_rejection", "copy"),
    ("Has_Background_Check_Passed__c", "has_background_check_passed", "copy"),
    ("Checkr_Candidate_ID__c", "checkr_candidate_id", "copy"),
    ("Total_Bans__c", "total_bans", "copy"),
    ("User_Who_Banned_Driver_First__c", "user_who_banned_driver_first", "copy"),
    ("User_Who_Banned_Driver_Last__c", "user_who_banned_driver_last", "copy"),
    ("First_Ban_Reason__c", "first_ban_reason", "copy"),
    ("Last_Ban_Reason__c", "last_ban_reason", "copy"),
    ("Is_Banned__c", "is_banned", "copy"),
    ("Active_Violation_Count__c", "active_violation_count", "copy"),
    ("Lifetime_Violation_Count__c", "lifetime_violation_count", "copy"),
    ("Most_Common_Violation__c", "most_common_violation", "copy"),
    ("Address_Line_1__c", "address_line_1", "copy"),
    ("Address_Line_2__c", "address_line_2", "copy"),
    ("City__c", "city", "cut40"),
    ("State__c", "state", "state"),
    ("CBSA__c", "cbsa_name", "copy"),
    ("Zip_Code__c", "zip_code", "copy"),
    ("ZCTA__c", "zcta", "copy"),
    ("Major_Region__c", "major_region", "copy"),
    ("Latitude__c", "address_latitude", "copy"),
    ("Longitude__c", "address_longitude", "copy"),
    ("Zip_Code_Latitude__c", "zip_code_latitude", "copy"),
    ("Zip_Code_Longitude__c", "zip_code_longitude", "copy"),
    ("Total_Completed_Deliveries__c", "total_completed_deliveries", "copy"),
    ("Total_Hotshot_Deliveries_Completed__c", "total_hotshots_deliveries_completed", "copy"),
    ("Total_Route_Deliveries_Completed__c", "total_route_deliveries_completed", "copy"),
    ("Total_Ratings__c", "total_ratings", "copy"),
    ("Total_Customer_Ratings__c", "total_customer_ratings", "copy"),
    ("Total_Internal_Ratings__c", "total_internal_ratings", "copy"),
    ("Average_Customer_Rating__c", "average_customer_rating", "copy"),
    ("Average_Internal_Rating__c", "average_internal_rating", "copy"),
    ("Weighted_Average_Rating__c", "weighted_average_rating", "copy"),
    ("All_Time_Score__c", "all_time_score", "copy"),
    ("On_Time_Destination_Score__c", "on_time_destination_score", "copy"),
    ("On_Time_Origin_Score__c", "on_time_origin_score", "copy"),
    ("On_Time_Score__c", "on_time_score", "copy"),
    ("Photos_Score__c", "photos_score", "copy"),
    ("Scorecard_Score__c", "scorecard_score", "copy"),
    ("Scorecard_Unassignments__c", "scorecard_unassignments", "copy"),
    ("Vehicle_Cargo_Capacity__c", "vehicle_cargo_capacity", "copy"),
    ("Vehicle_Max_Payload__c", "vehicle_max_payload", "copy"),
    ("Vehicle_Max_tow__c", "vehicle_max_tow", "copy"),
    ("Vehicle_Teoalida_ID__c", "vehicle_teoalida_id", "copy"),
    ("Vehicle_Year__c", "vehicle_year", "copy"),
    ("Vehicle_Class__c", "vehicle_class", "copy"),
    ("Vehicle_Make__c", "vehicle_make", "copy"),
    ("Vehicle_Model__c", "vehicle_model", "copy"),
    ("Vehicle_Trim__c", "vehicle_trim", "copy"),
    ("scorecard_completed_deliveries__c", "scorecard_completed_deliveries__c", "or_zero"),
    ("scorecard_completion_violations__c", "scorecard_completion_violations__c", "or_zero"),
    ("scorecard_completion_rate__c", "scorecard_completion_rate__c", "copy"),
    ("scorecard_accurate_deliveries__c", "scorecard_accurate_deliveries__c", "or_zero"),
    ("scorecard_delivery_accuracy__c", "scorecard_delivery_accuracy__c", "copy"),
    ("scorecard_average_customer_rating__c", "scorecard_average_customer_rating__c", "copy"),
    ("scorecard_rated_deliveries__c", "scorecard_rated_deliveries__c", "or_zero"),
    ("scorecard_eta_delivery_count__c", "scorecard_eta_delivery_count__c", "copy"),
    ("scorecard_pickup_ontime_percent__c", "scorecard_pickup_ontime_percent__c", "copy"),
    ("scorecard_dropoff_ontime_percent__c", "scorecard_dropoff_ontime_percent__c", "copy"),
    ("Has_App_Installed__c", "has_app_installed", "copy"),
    ("Has_Profile_Photo__c", "has_profile_photo", "copy"),
    ("Went_Through_Carrier_Flow__c", "went_through_carrier_flow", "copy"),
    ("contact_record_type", "contact_record_type", "copy"),
    ("Driver_Accessories__c", "Driver_Accessories__c", "copy"),
    ("Driver_Capabilities__c", "Driver_Capabilities__c", "copy"),
    ("Active_Violation_Types__c", "Active_Violation_Types__c", "copy"),
    ("Lifetime_Violation_types__c", "Lifetime_Violation_types__c", "copy"),
    ("Vehicle_Accessories__c", "Vehicle_Accessories__c", "copy"),
    ("Preferred_Delivery_Methods__c", "Preferred_Delivery_Methods__c", "copy"),
    ("Upscale_Delivery_Methods__c", "Upscale_Delivery_Methods__c", "copy"),
    ("PPE_certification", "certification", "copy"),
]
