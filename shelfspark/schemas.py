"""Domain table schemas and the positional column order of every output table."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


EVENT_TRACKING = _schema(
    ("event_id", L, False), ("unique_id", S, True), ("user_id", L, True), ("event_name", S, True),
    ("record_date", TS, True), ("current_url", S, True), ("referrer_url", S, True),
    ("event_properties", S, True), ("geo_location", S, True), ("user_agent", S, True),
    ("environment_name", S, True))
USER_TRACKING_EVENTS = _schema(
    ("user_id", L, True), ("session_id", S, True), ("event_name", S, True),
    ("event_timestamp", TS, True))
SUBSCRIPTIONS = _schema(
    ("user_id", L, True), ("start_timestamp", TS, True), ("end_timestamp", TS, True),
    ("subscription_canceled_at", TS, True), ("paid_start_timestamp", TS, True),
    ("paid_end_timestamp", TS, True), ("total_paid_gbp", T.DecimalType(18, 2), True),
    ("paid_months", I, True), ("payment_channel", S, True), ("subscription_type", S, True))
READING_ACTIVITY_DAILY = _schema(
    ("user_id", L, True), ("reading_date", DT, True), ("reading_duration_seconds", L, True))
USER_REGISTRATIONS = _schema(
    ("user_id", L, True), ("organisation_id", I, True), ("registration_time", TS, True),
    ("payment_channel_crude", S, True))
USER_SUMMARY = _schema(("user_id", L, True), ("internal_user", S, True))
USERS = _schema(("id", L, False), ("group_id", I, True), ("organisation_id", I, True))
GROUPS = _schema(("id", I, False), ("group_name", S, True), ("group_code", S, True))
ORGANISATIONS = _schema(("id", I, False), ("organisation_name", S, True))
BOOK_META = _schema(("id", L, False), ("gbp_price_exvat_float", D, True),
                    ("usd_price_exvat_float", D, True), ("eur_price_exvat_float", D, True))
ORG_HASHES = _schema(("organisation_id", I, True), ("hash", S, True))

DOMAIN = {
    "event_tracking": EVENT_TRACKING, "user_tracking_events": USER_TRACKING_EVENTS,
    "subscriptions": SUBSCRIPTIONS, "reading_activity_daily": READING_ACTIVITY_DAILY,
    "user_registrations": USER_REGISTRATIONS, "user_summary": USER_SUMMARY, "users": USERS,
    "groups": GROUPS, "organisations": ORGANISATIONS, "book_meta": BOOK_META,
    "org_hashes": ORG_HASHES,
}

# Positional output orders (inserts in the reference name no target columns).
REGISTER_SUMMARY_COLUMNS = [
    "unique_id", "main_reporting_id", "first_recorded_date", "organisation_code",
    "calculated_organisationid", "user_status", "nosignup_left_registration_page",
    "nosignup_another_page", "homepage_pre", "search_pre", "pricing_pre", "login_pre",
    "signup_pre", "mission_pre", "homepage_post", "search_post", "pricing_post", "login_post",
    "signup_post", "mission_post", "events_pre_register", "events_post_register",
    "group_register_page_count"]
BOOK_VIEWS_COLUMNS = ["book_id", "reporting_period_start", "unique_first_views"]
BOOK_VIEWS_GEO_COLUMNS = BOOK_VIEWS_COLUMNS + ["geo_location"]
CHURN_COLUMNS = [
    "user_id", "first_subscription_start_date", "first_subscription_end_date",
    "first_subscription_cancelled_date", "first_paid_start_date", "first_paid_end_date",
    "subscription_total_paid", "subscription_paid_months", "subscriber_churned_date",
    "days_till_churned", "weeks_till_churned", "subscriber_active"]
RFI_MONTHLY_COLUMNS = [
    "user_id", "combined_start_date", "combined_end_date", "days_since_login",
    "active_reading_days", "session_total_minutes", "combined_score", "reporting_start_date",
    "user_group", "combined_cohort"]
RFI_AVERAGE_COLUMNS = [
    "user_id", "combined_start_date", "reporting_end_date", "days_since_login",
    "avg_month_reading_days", "avg_month_mins_read", "user_group", "combined_score",
    "reporting_history_date", "combined_cohort"]
