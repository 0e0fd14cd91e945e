"""Fixed values that the business rules, schemas and checks depend on.

Everything in this module is a fixed value: dates, thresholds, seed rows, column
lists, check settings and declared tests.  No logic lives here.
"""

from __future__ import annotations

from datetime import date

# --- fixed values: calendar -------------------------------------------------
FIRST_DAY = date(2024, 1, 1)
LAST_DAY = date(2026, 12, 31)
FIRST_MONTH_KEY = 202401
SPINE_STEP_DAYS = 30

# --- fixed values: business thresholds --------------------------------------
CHURN_GAP_DAYS = 60
REACTIVATION_GAP_DAYS = 60
USAGE_WINDOW_DAYS = 30
IDLE_DAYS = 90
CHECK_WINDOW_DAYS = 30
SATISFACTION_RANGE = (1, 5)
UNKNOWN_REASON = "unknown"

# --- fixed values: plan ladder, list prices, discounts -----------------------
PLAN_TIERS = ("Free", "Basic", "Pro", "Enterprise")
PLAN_SEED = (
    ("Free", 0.0, "none", "Free tier, no billing", 1000),
    ("Basic", 10.0, "monthly", "Basic plan, per seat per month", 1000),
    ("Pro", 25.0, "monthly", "Pro plan, per seat per month", 1000),
    ("Enterprise", 60.0, "mixed", "Enterprise, negotiated pricing", 1000),
)
PLAN_SEED_COLUMNS = (
    "plan_tier string, price_per_seat_usd double, billing_type string, "
    "description string, _updated_at bigint"
)
DISCOUNT_RATES = {"Free": 0.0, "Basic": 0.05, "Pro": 0.10, "Enterprise": 0.20}

# --- fixed values: refund and satisfaction rules ------------------------------
REFUND_TERM_DAYS = 30
REFUND_MONTH_DAYS = 20
REFUND_MIN_MONTHS = 0.1
REFUND_SHARE = 0.5
SATISFACTION_TOP = 5
ESCALATION_PENALTY = 2

# --- fixed values: health score points -----------------------------------------
HEALTH_BASE = 50
HEALTH_ACTIVE = 15
HEALTH_PAYING = 10
HEALTH_SATISFIED = 10
HEALTH_USING = 10
HEALTH_CHURNED = -15
HEALTH_OPEN_HIGH = -10
HEALTH_IDLE = -10
SATISFIED_FROM = 4.0
UNSATISFIED_BELOW = 3.0
SATISFACTION_WHEN_UNKNOWN = 5.0

# --- fixed values: cells read as missing in text sources ------------------------
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- fixed values: characters that count as blank at the ends of a cell -----------
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: lineage ---------------------------------------------------------
LINEAGE_COLUMNS = "_ingestion_time string, _source_system string, _batch_id string"

# --- fixed values: raw columns, in file order ---------------------------------------
RAW_COLUMNS = {
    "accounts": (
        "account_id string, account_name string, industry string, country string, "
        "signup_date timestamp, referral_source string, plan_tier string, seats int, "
        "is_trial boolean, churn_flag boolean"
    ),
    "subscriptions": (
        "subscription_id string, account_id string, start_date timestamp, "
        "end_date timestamp, plan_tier string, seats int, price double, "
        "discount_value double, mrr_amount double, arr_amount double, is_trial boolean, "
        "upgrade_flag boolean, downgrade_flag boolean, churn_flag boolean, "
        "billing_frequency string, auto_renew_flag boolean, next_start timestamp, "
        "is_reactivation boolean"
    ),
    "churn_events": (
        "churn_event_id string, account_id string, churn_date timestamp, "
        "reason_code string, refund_amount_usd double, preceding_upgrade_flag boolean, "
        "preceding_downgrade_flag boolean, is_reactivation boolean, feedback_text string"
    ),
    "feature_usage": (
        "usage_id string, subscription_id string, usage_date timestamp, "
        "feature_name string, usage_count bigint, usage_duration_secs bigint, "
        "error_count bigint, is_beta_feature boolean"
    ),
    "support_tickets": (
        "ticket_id string, account_id string, submitted_at timestamp, "
        "closed_at timestamp, resolution_time_hours double, priority string, "
        "first_response_time_minutes int, satisfaction_score double, "
        "escalation_flag boolean"
    ),
}

# --- fixed values: staging columns, in table order (lineage columns follow) -----------
STAGING_COLUMNS = {
    "accounts": (
        "account_id string, account_name string, industry string, country string, "
        "signup_date date, referral_source string, plan_tier string, seats int, "
        "is_trial boolean, churn_flag boolean"
    ),
    "subscriptions": (
        "subscription_id string, account_id string, start_date date, end_date date, "
        "plan_tier string, seats int, price double, discount_value double, "
        "mrr_amount double, arr_amount double, is_trial boolean, upgrade_flag boolean, "
        "downgrade_flag boolean, churn_flag boolean, reactivation_flag boolean, "
        "billing_frequency string, auto_renew_flag boolean, subscription_sequence bigint, "
        "days_active int"
    ),
    "churn_events": (
        "churn_event_id string, account_id string, churn_date date, reason_code string, "
        "refund_amount_usd double, preceding_upgrade_flag boolean, "
        "preceding_downgrade_flag boolean, is_reactivation boolean, feedback_text string"
    ),
    "feature_usage": (
        "usage_id string, subscription_id string, usage_date date, feature_name string, "
        "usage_count bigint, usage_duration_secs bigint, error_count bigint, "
        "is_beta_feature boolean"
    ),
    "support_tickets": (
        "ticket_id string, account_id string, submitted_at timestamp, "
        "closed_at timestamp, resolution_time_hours double, priority string, "
        "first_response_time_minutes int, satisfaction_score double, "
        "escalation_flag boolean"
    ),
}

# --- fixed values: mart columns ----------------------------------------------------------
MART_COLUMNS = {
    "mrr_monthly": (
        "year int, month int, plan_tier string, active_accounts bigint, "
        "new_accounts bigint, churned_accounts bigint, total_mrr double, "
        "total_arr double, avg_mrr_per_account double, total_seats bigint"
    ),
    "churn_summary": (
        "year int, month int, reason_code string, churn_count bigint, "
        "total_refund_usd double, reactivation_count bigint, churn_rate_pct double"
    ),
    "feature_usage_summary": (
        "year int, month int, feature_name string, total_usage_count bigint, "
        "total_duration_secs bigint, total_error_count bigint, "
        "unique_subscriptions bigint, avg_usage_per_sub double, beta_usage_count bigint"
    ),
    "customer_health_score": (
        "account_id string, account_name string, plan_tier string, country string, "
        "industry string, health_score bigint, mrr_last_month double, "
        "avg_satisfaction double, total_usage_30d bigint, open_high_tickets bigint, "
        "churn_risk string, days_since_last_activity bigint"
    ),
}
MART_KEYS = {
    "mrr_monthly": ("year", "month", "plan_tier"),
    "churn_summary": ("year", "month", "reason_code"),
    "feature_usage_summary": ("year", "month", "feature_name"),
    "customer_health_score": ("account_id",),
}

# --- fixed values: texts of the batch checks -------------------------------------------
CHECK_TEXT = {
    "rows": " rows",
    "null_key": " nulls in '{key}'",
    "repeated_key": " duplicates in '{key}'",
    "no_revenue": "no revenue columns",
    "revenue_good": "all >= 0",
    "revenue_bad": "negative",
    "no_order": "not applicable",
    "order_missing": "columns missing: {columns}",
    "order": " rows where end < start",
    "bounds_missing": "'{column}' not found",
    "bounds": " rows outside [{first}, {last}]",
    "critical_good": "all critical cols non-null",
    "critical_bad": "nulls",
    "empty": "no rows in the window",
}

# --- fixed values: watermark keys -------------------------------------------------------
WATERMARK_KEYS = (
    "ingestion_accounts",
    "ingestion_subscriptions",
    "ingestion_churn_events",
    "ingestion_feature_usage",
    "ingestion_support_tickets",
    "transform_accounts",
    "transform_subscriptions",
    "transform_churn_events",
    "transform_feature_usage",
    "transform_support_tickets",
    "warehouse_dim_accounts",
    "warehouse_fact_subscriptions",
    "warehouse_fact_churn_events",
    "warehouse_fact_feature_usage",
    "warehouse_fact_support_tickets",
)

# --- fixed values: declared tests (model, column, test, argument) -------------------------
DECLARED_TESTS = (
    ("dim_accounts", "account_id", "unique", None),
    ("dim_accounts", "account_id", "not_null", None),
    ("dim_accounts", "signup_date", "not_null", None),
    ("dim_plans", "plan_tier", "unique", None),
    ("dim_plans", "plan_tier", "not_null", None),
    ("fact_subscriptions", "subscription_id", "unique", None),
    ("fact_subscriptions", "subscription_id", "not_null", None),
    ("fact_subscriptions", "account_id", "not_null", None),
    ("fact_subscriptions", "mrr_amount", "not_null", None),
    ("fact_subscriptions", "mrr_amount", "expression_is_true", ">= 0"),
    ("fact_churn_events", "churn_event_id", "unique", None),
    ("fact_churn_events", "churn_event_id", "not_null", None),
    ("fact_churn_events", "account_id", "not_null", None),
    ("fact_churn_events", "refund_amount_usd", "expression_is_true", ">= 0"),
    ("fact_feature_usage", "usage_id", "unique", None),
    ("fact_feature_usage", "usage_id", "not_null", None),
    ("fact_feature_usage", "subscription_id", "not_null", None),
    ("fact_support_tickets", "ticket_id", "unique", None),
    ("fact_support_tickets", "ticket_id", "not_null", None),
    ("fact_support_tickets", "account_id", "not_null", None),
    ("mrr_monthly", "year", "not_null", None),
    ("mrr_monthly", "month", "not_null", None),
    ("mrr_monthly", "plan_tier", "not_null", None),
    ("mrr_monthly", "total_mrr", "not_null", None),
    ("mrr_monthly", "total_mrr", "expression_is_true", ">= 0"),
    ("mrr_monthly", "total_arr", "expression_is_true", ">= 0"),
    ("mrr_monthly", "active_accounts", "expression_is_true", ">= 0"),
    ("churn_summary", "year", "not_null", None),
    ("churn_summary", "month", "not_null", None),
    ("churn_summary", "reason_code", "not_null", None),
    ("churn_summary", "churn_count", "expression_is_true", "> 0"),
    ("churn_summary", "total_refund_usd", "expression_is_true", ">= 0"),
    ("churn_summary", "churn_rate_pct", "expression_is_true", ">= 0"),
    ("feature_usage_summary", "year", "not_null", None),
    ("feature_usage_summary", "month", "not_null", None),
    ("feature_usage_summary", "feature_name", "not_null", None),
    ("feature_usage_summary", "total_usage_count", "expression_is_true", ">= 0"),
    ("feature_usage_summary", "unique_subscriptions", "expression_is_true", "> 0"),
    ("customer_health_score", "account_id", "unique", None),
    ("customer_health_score", "account_id", "not_null", None),
    ("customer_health_score", "health_score", "not_null", None),
    ("customer_health_score", "health_score", "expression_is_true", ">= 0"),
    ("customer_health_score", "health_score", "expression_is_true", "<= 100"),
    ("customer_health_score", "churn_risk", "accepted_values", "low,medium,high"),
    ("customer_health_score", "mrr_last_month", "expression_is_true", ">= 0"),
)
