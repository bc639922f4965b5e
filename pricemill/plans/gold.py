"""Star schema and marts: calendar, commodity and region dimensions, price fact, features, monthly prices."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import domain
from ..functions import columns as C
from ..functions.calendar import calendar_columns, month_start
from ..functions.values import FINE, PRICE, exact_mean, exact_mean_over, percent_change
from ..operators.series import series_window, trailing

PRICE_COLUMNS = [
    "commodity",
    "price_date",
    "region",
    "country",
    "price_usd_per_kg",
    "currency",
    "unit",
    "source",
    "ingested_at",
]


def dim_date(
    spark: SparkSession,
    as_of: date,
    start: date = date.fromisoformat(domain.CALENDAR_START),
    end: date = date.fromisoformat(domain.CALENDAR_END),
    lookahead_days: int = domain.CALENDAR_LOOKAHEAD_DAYS,
) -> DataFrame:
    """One row per day from ``start`` to the later of ``end`` and ``as_of`` plus the lookahead."""
    last = max(end, as_of + timedelta(days=lookahead_days))
    days = spark.range((last - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    return days.select(*[c.alias(name) for name, c in calendar_columns(F.col("d")).items()])


def dim_commodity(mapping: DataFrame) -> DataFrame:
    return (
        mapping.filter(F.col("commodity").isin(*domain.COMMODITY_IDS))
        .select(C.commodity_id(F.col("commodity")).alias("commodity_id"), "commodity", "name_vi", "category")
        .distinct()
    )


def dim_region(monthly: DataFrame, daily: DataFrame) -> DataFrame:
    """Distinct markets of both sources, numbered by country, region and source.

    The number is the market's place within its country plus the count of markets of earlier countries,
    so no single task sorts all markets; only one row per country meets in one place.
    """
    keys = ["country", "region", "source"]
    markets = monthly.select(*keys).unionByName(daily.select(*keys)).distinct()
    in_country = Window.partitionBy("country").orderBy("region", "source")
    sizes = markets.groupBy("country").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("country").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("country", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return (
        markets.withColumn("_place", F.row_number().over(in_country))
        .join(offsets, "country")
        .select(
            (F.col("_offset") + F.col("_place")).cast("long").alias("region_id"),
            *keys,
            C.is_domestic_market(F.col("country")).alias("is_vietnam_market"),
        )
    )


def all_prices(monthly: DataFrame, daily: DataFrame) -> DataFrame:
    """Monthly and daily prices in one frame; monthly prices are never imputed."""
    observed = monthly.select(*PRICE_COLUMNS).withColumn("is_imputed", F.lit(False))
    return observed.unionByName(daily.select(*PRICE_COLUMNS, "is_imputed"))


def fact_price_daily(
    monthly: DataFrame, daily: DataFrame, commodities: DataFrame, dates: DataFrame, regions: DataFrame
) -> DataFrame:
    """Prices with dimension keys and rolling metrics per commodity, region and source.

    No dimension is hinted: Spark broadcasts those whose measured size allows it and splits hot keys of
    the others. All windows share one partitioning and one sort.
    """
    return priced_series(all_prices(monthly, daily), commodities, dates, regions)


def priced_series(prices: DataFrame, commodities: DataFrame, dates: DataFrame, regions: DataFrame) -> DataFrame:
    """The fact's rows for whole series, or for their ends with as many rows before as the means reach."""
    keyed = (
        prices.join(commodities.select("commodity_id", "commodity"), "commodity")
        .join(dates.select("date_id", F.col("date").alias("price_date")), "price_date")
        .join(regions.select("region_id", "country", "region", "source"), ["country", "region", "source"])
    )
    series = ["commodity_id", "region_id", "source"]
    w = series_window(series)
    price = F.col("price_usd_per_kg")
    hash_text = F.concat(
        "source", F.lit("|"), "commodity", F.lit("|"), F.col("price_date").cast("string"), F.lit("|"), "region"
    )
    return keyed.select(
        "*",
        F.md5(hash_text).alias("price_id"),
        F.lag(price).over(w).alias("previous_price_usd_per_kg"),
        exact_mean_over(price, trailing(series, 7)).alias("price_7d_avg"),
        exact_mean_over(price, trailing(series, 30)).alias("price_30d_avg"),
    ).select(
        "price_id",
        "commodity_id",
        "date_id",
        "region_id",
        "price_date",
        "commodity",
        "region",
        "country",
        "price_usd_per_kg",
        "previous_price_usd_per_kg",
        percent_change(price, F.col("previous_price_usd_per_kg")).alias("price_change_pct"),
        "price_7d_avg",
        "price_30d_avg",
        "currency",
        "unit",
        "source",
        "ingested_at",
        "is_imputed",
    )


def daily_across_sources(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Mean price and metrics per day and commodity over all regions and sources, with calendar attributes.

    The calendar attributes depend on the day alone, so they are joined after the aggregation, on far
    fewer rows, instead of being grouping keys.
    """
    daily = fact.groupBy("date_id", "price_date", "commodity").agg(
        exact_mean(F.col("price_usd_per_kg")).alias("price_usd_per_kg"),
        exact_mean(F.col("price_change_pct"), FINE).alias("price_change_pct"),
        exact_mean(F.col("price_7d_avg"), FINE).alias("price_7d_avg"),
        exact_mean(F.col("price_30d_avg"), FINE).alias("price_30d_avg"),
        F.count_distinct("source").alias("source_count"),
    )
    attributes = ["year", "quarter", "month", "week", "is_weekend", "is_vietnam_public_holiday"]
    return daily.join(dates.select("date_id", *attributes), "date_id").drop("date_id")


def gold_ml_features(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Feature mart: one row per day and commodity with lags, long means, volatility and season."""
    return with_history(daily_across_sources(fact, dates))


def with_history(daily: DataFrame) -> DataFrame:
    """Daily prices of whole commodities, or of their ends with the rows before that windows reach, with the features
    that look back."""
    w = series_window(["commodity"])
    price = F.col("price_usd_per_kg")
    return daily.select(
        "price_date",
        "commodity",
        "year",
        "quarter",
        "month",
        "week",
        "is_weekend",
        "is_vietnam_public_holiday",
        C.is_harvest_season(F.col("commodity"), F.col("month")).alias("is_harvest_season"),
        "price_usd_per_kg",
        "price_change_pct",
        "price_7d_avg",
        "price_30d_avg",
        exact_mean_over(price, trailing(["commodity"], 90), FINE).alias("price_90d_avg"),
        F.stddev_samp(price).over(trailing(["commodity"], 30)).alias("price_30d_volatility"),
        F.lag(price, 1).over(w).alias("price_lag_1"),
        F.lag(price, 7).over(w).alias("price_lag_7"),
        F.lag(price, 30).over(w).alias("price_lag_30"),
        "source_count",
    )


def gold_monthly_combined(monthly: DataFrame, daily: DataFrame) -> DataFrame:
    """Monthly prices of the monthly source, and monthly means of the daily source."""
    keys = ["commodity", "month_date", "region", "country", "currency"]
    of_month = monthly.withColumnRenamed("price_date", "month_date").select(
        *keys, F.col("price_usd_per_kg").cast("double").alias("price"), "source"
    )
    averaged = (
        daily.withColumn("month_date", month_start(F.col("price_date")))
        .groupBy(*keys)
        .agg(exact_mean(F.col("price_usd_per_kg")).alias("price"))
        .withColumn("source", F.lit(domain.DAILY_MONTHLY_AVG_SOURCE))
    )
    return of_month.unionByName(averaged).select(
        "commodity",
        "month_date",
        F.col("price").cast(PRICE).alias("price_usd_per_kg"),
        "region",
        "country",
        "currency",
        "source",
    )
