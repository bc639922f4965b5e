"""Cleaned prices: tolerant columns, canonical names, dates, USD per kg, latest load wins, weekend fill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domain
from ..functions import columns as C
from ..functions.values import PRICE
from ..operators.lookups import resolve_alias
from ..operators.series import fill_weekends, latest_per_key

#: A cleaned table has a single source, which therefore need not be a key.
DEDUP_KEYS = ["price_date", "commodity", "region"]
SERIES_KEYS = ["commodity", "region", "source"]


def is_valid_price(scope: Sequence[str] = domain.PRICE_SCOPE) -> Column:
    """In scope, with a day and a positive price."""
    return F.col("commodity").isin(*scope) & F.col("price_date").isNotNull() & (F.col("price_usd_per_kg") > 0)


def standardize_monthly(raw: DataFrame, mapping: DataFrame | Mapping[str, str], now: Column) -> DataFrame:
    """Monthly quotes in the common layout, before validation and deduplication."""
    typed = raw.select(
        C.pick(raw, ["commodity", "indicator_name", "item", "product", "product_name", "name"]).alias("raw_commodity"),
        C.pick(raw, ["date", "price_date", "period", "year_month", "month_date"]).alias("raw_date"),
        C.pick(raw, ["year"], "int").alias("raw_year"),
        C.pick(raw, ["month"], "int").alias("raw_month"),
        C.pick(raw, ["region", "market", "market_name", "area", "province"]).alias("raw_region"),
        C.pick(raw, ["country", "country_name"]).alias("raw_country"),
        C.pick(raw, ["price", "value", "price_usd", "price_usd_per_kg"], PRICE).alias("raw_price"),
        C.pick(raw, ["currency"]).alias("raw_currency"),
        C.pick(raw, ["unit", "price_unit"]).alias("raw_unit"),
        C.pick(raw, ["ingested_at", "loaded_at", "created_at"], "timestamp_ntz").alias("raw_ingested_at"),
    )
    return resolve_alias(typed, "raw_commodity", mapping).select(
        "commodity",
        C.parse_period(F.col("raw_date"), F.col("raw_year"), F.col("raw_month")).alias("price_date"),
        C.blank_default(F.col("raw_region"), domain.MONTHLY_REGION).alias("region"),
        C.blank_default(F.col("raw_country"), domain.MONTHLY_COUNTRY).alias("country"),
        C.monthly_price_per_kg(F.col("commodity"), F.col("raw_unit"), F.col("raw_price")).alias("price_usd_per_kg"),
        C.currency_default(F.col("raw_currency")).alias("currency"),
        C.blank_default(F.col("raw_unit"), "kg").alias("unit"),
        F.coalesce("raw_ingested_at", now).alias("ingested_at"),
    )


def standardize_daily(raw: DataFrame, mapping: DataFrame | Mapping[str, str], now: Column) -> DataFrame:
    """Daily quotes in the common layout, before validation and deduplication."""
    typed = raw.select(
        C.pick(raw, ["commodity", "product", "product_name"]).alias("raw_commodity"),
        C.pick_day(raw, ["price_date", "date", "period"]).alias("price_date"),
        C.pick(raw, ["price_usd_per_kg"], PRICE).alias("raw_per_kg"),
        C.pick(raw, ["price_usd", "close"], PRICE).alias("raw_close"),
        C.pick(raw, ["ticker", "symbol"]).alias("raw_ticker"),
        C.pick(raw, ["raw_unit", "unit", "price_unit"]).alias("raw_unit"),
        C.pick(raw, ["region", "market"]).alias("raw_region"),
        C.pick(raw, ["country", "country_name"]).alias("raw_country"),
        C.pick(raw, ["currency"]).alias("raw_currency"),
        C.pick(raw, ["ingested_at", "loaded_at", "created_at"], "timestamp_ntz").alias("raw_ingested_at"),
    )
    per_kg = C.daily_price_per_kg(F.col("raw_per_kg"), F.col("raw_unit"), F.col("raw_ticker"), F.col("raw_close"))
    return resolve_alias(typed, "raw_commodity", mapping).select(
        "commodity",
        "price_date",
        C.blank_default(F.col("raw_region"), domain.DAILY_REGION).alias("region"),
        C.blank_default(F.col("raw_country"), domain.DAILY_COUNTRY).alias("country"),
        per_kg.alias("price_usd_per_kg"),
        F.col("raw_close").alias("close_price"),
        C.blank_default(F.col("raw_ticker"), "unknown").alias("ticker"),
        C.blank_default(F.col("raw_unit"), "unknown").alias("unit"),
        C.currency_default(F.col("raw_currency")).alias("currency"),
        F.coalesce("raw_ingested_at", now).alias("ingested_at"),
    )


def _latest_load(standardized: DataFrame, source: str, scope: Sequence[str]) -> DataFrame:
    # The scope is cheap to test, so it also cuts rows before the aggregation.
    in_scope = standardized.filter(F.col("commodity").isin(*scope))
    kept = latest_per_key(in_scope, DEDUP_KEYS, ["ingested_at", "price_usd_per_kg"], is_valid_price(scope))
    return kept.withColumns({"price_usd_per_kg": F.col("price_usd_per_kg").cast(PRICE), "source": F.lit(source)})


def clean_monthly(
    raw: DataFrame, mapping: DataFrame | Mapping[str, str], now: Column, scope: Sequence[str] = domain.PRICE_SCOPE
) -> DataFrame:
    return _latest_load(standardize_monthly(raw, mapping, now), domain.MONTHLY_SOURCE, scope).select(
        "commodity", "price_date", "region", "country", "price_usd_per_kg", "currency", "unit", "source", "ingested_at"
    )


def observed_daily(
    raw: DataFrame, mapping: DataFrame | Mapping[str, str], now: Column, scope: Sequence[str] = domain.PRICE_SCOPE
) -> DataFrame:
    """Daily prices as observed, one row per commodity, day, region and source."""
    return _latest_load(standardize_daily(raw, mapping, now), domain.DAILY_SOURCE, scope)


def clean_daily(
    raw: DataFrame,
    mapping: DataFrame | Mapping[str, str],
    dim_date: DataFrame,
    now: Column,
    scope: Sequence[str] = domain.PRICE_SCOPE,
) -> DataFrame:
    """Observed daily prices plus weekend days filled from at most three days before.

    Days outside the calendar are dropped, as :func:`outside_calendar` reports. A filled row takes all
    attributes of the observation it repeats, so a change of ticker or unit within a series does not
    duplicate days.
    """
    observed = observed_daily(raw, mapping, now, scope)
    on_calendar = observed.join(_calendar_days(dim_date), "price_date", "left_semi")
    return fill_weekends(on_calendar, SERIES_KEYS, carry=["close_price"]).select(
        "commodity",
        "price_date",
        "region",
        "country",
        "price_usd_per_kg",
        "currency",
        "unit",
        "source",
        "ingested_at",
        "ticker",
        "close_price",
        "is_imputed",
    )


def outside_calendar(observed: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Observations that the inner joins to the calendar lose, with counts per series."""
    return (
        observed.join(_calendar_days(dim_date), "price_date", "left_anti")
        .groupBy(*SERIES_KEYS)
        .agg(F.count(F.lit(1)).alias("dropped_rows"))
    )


def _calendar_days(dim_date: DataFrame) -> DataFrame:
    return dim_date.select(F.col("date").alias("price_date"))
