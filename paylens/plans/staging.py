"""Staging models: which columns of a raw table go on, and which key must be present."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from paylens.plans.payments import stage

# Raw table, required key (None: no filter) and columns of each model.
STAGING = {
    "stg_transactions": ("transactions", "transaction_id", [
        "transaction_id", "customer_id", "merchant_id", "amount", "currency", "payment_method", "transaction_date", "transaction_status",
        "failure_reason", "device_id", "ip_address",
    ]),
    "stg_customers": ("customers", "customer_id", [
        "customer_id", "first_name", "last_name", "customer_email", "customer_phone", "date_of_birth", "home_address", "pan_number",
        "kyc_status", "registration_date", "last_login_at", "account_tier", "is_active",
    ]),
    "stg_merchants": ("merchants", "merchant_id", [
        "merchant_id", "merchant_name", "business_category", "merchant_city", "merchant_state", "gstin", "bank_account_number",
        "ifsc_code", "contact_email", "contact_phone", "onboarding_date", "contract_start_date", "contract_end_date",
        "sla_threshold_inr", "is_active",
    ]),
    "stg_events": ("events", "event_id", [
        "event_id", "customer_id", "event_type", "event_timestamp", "session_id", "device_type", "os_version", "app_version",
        "screen_name", "latitude", "longitude",
    ]),
    "stg_workforce": ("workforce", "emp_id", [
        "emp_id", "emp_code", "first_name", "last_name", "personal_email", "mobile_number", "date_of_birth", "gender", "home_address",
        "emergency_contact_name", "emergency_contact_phone", "pan_number", "uan_number", "pf_account_number", "bank_account_number",
        "ifsc_code", "joining_date", "department_id", "designation_id", "reporting_mgr_id", "employment_type", "work_location",
        "is_active",
    ]),
    "stg_compensation": ("compensation", "emp_id", [
        "emp_id", "effective_date", "basic_ctc", "hra_amount", "special_allowance", "gross_ctc", "employer_pf_contribution",
        "employer_esi_contribution", "grade_band", "salary_revision_reason", "approved_by_mgr_id",
    ]),
    "stg_monthly_payroll": ("monthly_payroll", None, [
        "payroll_id", "emp_id", "payroll_month", "working_days", "present_days", "lop_days", "gross_earnings", "basic_pay", "hra_paid",
        "special_allowance_paid", "overtime_amount", "performance_bonus", "tds_deducted", "pf_deducted", "esi_deducted", "pt_deducted",
        "loan_recovery", "net_take_home", "payment_status", "payment_date",
    ]),
    "stg_performance": ("performance_reviews", None, [
        "review_id", "emp_id", "review_cycle", "reviewer_emp_id", "self_rating", "manager_rating", "final_rating", "rating_label",
        "strengths_comment", "improvement_areas", "promotion_recommended", "pip_initiated", "review_status",
    ]),
    "stg_separations": ("separations", None, [
        "separation_id", "emp_id", "separation_type", "resignation_date", "last_working_date", "exit_interview_done",
        "exit_reason_category", "exit_reason_detail", "rehire_eligible", "full_final_amount", "full_final_status",
    ]),
    "stg_orders": ("orders", "order_id", [
        "order_id", "user_id", "outlet_id", "rider_id", "order_placed_at", "order_confirmed_at", "picked_up_at", "delivered_at",
        "delivery_address", "drop_lat", "drop_lng", "item_total", "delivery_fee", "platform_discount", "final_amount_paid",
        "payment_method", "promo_code_used", "surge_multiplier", "otp_verified", "order_status", "cancellation_reason",
    ]),
    "stg_outlets": ("outlets", None, [
        "outlet_id", "outlet_name", "cuisine_type", "owner_name", "owner_mobile", "owner_email", "fssai_number", "gst_number",
        "outlet_address", "outlet_lat", "outlet_lng", "avg_prep_time_mins", "avg_rating", "is_pure_veg", "accepts_cash",
        "commission_pct", "onboarded_date", "is_active",
    ]),
    "stg_ratings": ("ratings", None, [
        "rating_id", "order_id", "user_id", "rider_id", "outlet_id", "user_rating_for_food", "user_rating_for_rider", "user_comment",
        "outlet_rating_for_user", "rider_rating_for_user", "rating_timestamp",
    ]),
    "stg_riders": ("riders", "rider_id", [
        "rider_id", "full_name", "mobile_number", "email", "date_of_birth", "dl_number", "dl_expiry_date", "vehicle_number",
        "vehicle_type", "bank_account_number", "ifsc_code", "home_address", "current_lat", "current_lng", "onboarding_date",
        "background_check_status", "is_available", "total_deliveries", "avg_rating",
    ]),
    "stg_users": ("users", "user_id", [
        "user_id", "full_name", "registered_email", "mobile_number", "home_address", "home_lat", "home_lng", "office_address",
        "office_lat", "office_lng", "date_of_birth", "device_id", "signup_date", "last_active_at", "total_orders", "wallet_balance",
        "preferred_payment", "is_premium",
    ]),
}


def staging_model(name: str, raw: dict[str, DataFrame], loaded_at: Column) -> DataFrame:
    """One staging model over the raw tables; transactions also need a positive amount."""
    source, key, columns = STAGING[name]
    rows = raw[source]
    if name == "stg_transactions":
        rows = rows.where("amount > 0")
    return stage(rows, columns, key, loaded_at)
