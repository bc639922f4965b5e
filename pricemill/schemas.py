"""Declared table schemas as DDL text, which readers and ``CREATE TABLE`` both accept."""

BRONZE_MONTHLY = (
    "price_date string, original_name string, price_usd string, commodity string, source string, "
    "ingested_at timestamp_ntz"
)
BRONZE_DAILY = (
    "price_date date, price_usd double, price_usd_per_kg double, commodity string, source string, "
    "ticker string, raw_unit string, currency string, region string, country string, ingested_at timestamp_ntz"
)
PRICE_ALERTS = (
    "alert_id string, alert_date date, commodity string, old_price double, new_price double, "
    "pct_change double, threshold double, ai_comment string, created_at timestamp_ntz"
)
COMMODITY_MAPPING = "raw_name string, commodity string, name_vi string, category string"
QUOTES = "ticker string, close double, quoted_on date"
FORECAST = (
    "forecast_date date, commodity string, predicted_price double, ci_lower double, ci_upper double"
)
