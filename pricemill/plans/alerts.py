"""Threshold alerts on daily closes and the daily increment, as set-based jobs over all commodities."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domain
from ..functions.columns import contract_price_per_kg
from ..functions.values import lookup, percent_change
from ..operators.lookups import previous_close
from ..operators.series import latest_per_key, series_window

ALERT_COLUMNS = [
    "alert_id",
    "alert_date",
    "commodity",
    "old_price",
    "new_price",
    "pct_change",
    "threshold",
    "ai_comment",
    "created_at",
]


@dataclass
class Increment:
    """What one load of quotes produces, all read against the state before the load."""

    alerts: DataFrame
    prices: DataFrame
    rejects: DataFrame


def usable_quotes(quotes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quotes of known tickers with a price, and the rest with the reason, so one bad row stops nothing."""
    tagged = quotes.withColumn("commodity", lookup(F.col("ticker"), domain.TICKERS)).withColumn(
        "reject_reason",
        F.when(F.col("commodity").isNull(), "unknown ticker")
        .when(F.col("close").isNull() | F.isnan("close"), "no price")
        .when(F.col("quoted_on").isNull(), "no date"),
    )
    good = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, tagged.filter(F.col("reject_reason").isNotNull())


def quotes_to_prices(quotes: DataFrame, now: Column) -> DataFrame:
    """Raw daily rows from usable quotes, one per commodity and day."""
    rows = quotes.select(
        F.col("quoted_on").alias("price_date"),
        F.col("close").alias("price_usd"),
        contract_price_per_kg(F.col("commodity"), F.col("close")).alias("price_usd_per_kg"),
        "commodity",
        F.lit(domain.DAILY_RAW_SOURCE).alias("source"),
        "ticker",
        F.lit("unit_contract").alias("raw_unit"),
        F.lit("USD").alias("currency"),
        F.lit(domain.DAILY_REGION).alias("region"),
        F.lit(domain.DAILY_COUNTRY).alias("country"),
        now.alias("ingested_at"),
    )
    return latest_per_key(rows, ["price_date", "commodity"], ["ingested_at", "price_usd"])


def alert_records(
    moves: DataFrame,
    now: Column,
    thresholds: Mapping[str, float] = domain.THRESHOLDS,
    default_threshold: float = domain.DEFAULT_THRESHOLD,
) -> DataFrame:
    """Alerts for moves (commodity, price_date, old_price, new_price) that reach their threshold.

    Commodities without a positive old price give none. The id ends in the change rounded half to even.
    """
    pct = F.col("pct_change")
    direction = F.when(pct > 0, domain.DIRECTION_UP).otherwise(domain.DIRECTION_DOWN)
    threshold = F.coalesce(lookup(F.col("commodity"), thresholds), F.lit(default_threshold))
    rounded = F.bround(F.abs(pct), 0).cast("long").cast("string")
    day_code = F.date_format("price_date", "yyyyMMdd")
    comment = F.format_string("%s %s %.2f%%", F.col("commodity"), direction, F.abs(pct))
    return (
        moves.filter(F.col("old_price") > 0)
        .withColumns({"pct_change": percent_change(F.col("new_price"), F.col("old_price")), "threshold": threshold})
        .filter(F.abs("pct_change") >= F.col("threshold"))
        .select(
            F.concat(F.lit("ALT_"), "commodity", F.lit("_"), day_code, F.lit("_"), rounded).alias("alert_id"),
            F.col("price_date").alias("alert_date"),
            "commodity",
            "old_price",
            "new_price",
            "pct_change",
            "threshold",
            comment.alias("ai_comment"),
            now.alias("created_at"),
        )
    )


def threshold_alerts(
    incoming: DataFrame, history: DataFrame, as_of: date, now: Column, **thresholds
) -> DataFrame:
    """Alerts for one day's prices against the latest price before that day."""
    before = previous_close(history, F.lit(as_of))
    moves = incoming.filter(F.col("price_date") == F.lit(as_of)).select(
        "commodity", "price_date", F.col("price_usd_per_kg").alias("new_price")
    )
    return alert_records(moves.join(before.select("commodity", "old_price"), "commodity", "left"), now, **thresholds)


def successive_moves(closes: DataFrame) -> DataFrame:
    """Each close with the one before it; input has one row per commodity and day."""
    previous = F.lag("price_usd_per_kg").over(series_window(["commodity"]))
    return closes.select(
        "commodity", "price_date", F.col("price_usd_per_kg").alias("new_price"), previous.alias("old_price")
    )


def multi_day_alerts(incoming: DataFrame, history: DataFrame, now: Column, **thresholds) -> DataFrame:
    """Alerts for prices of any number of days, each against the close before its own day.

    Closes of the load take the place of stored ones of the same day, and each commodity starts from the
    last stored close before its first incoming day, so the stored history before that is aggregated,
    never sorted. Running a load again gives the same alerts.
    """
    key, day, price = "commodity", F.col("price_date"), "price_usd_per_kg"
    first_days = incoming.groupBy(key).agg(F.min("price_date").alias("_first"))
    stored = history.select(key, "price_date", price).join(first_days, key)
    anchors = (
        stored.filter(day < F.col("_first"))
        .groupBy(key)
        .agg(F.max(F.struct("price_date", price)).alias("_last"))
        .select(key, "_last.price_date", f"_last.{price}", F.lit(False).alias("_new"))
    )
    arriving = incoming.select(key, "price_date", price)
    later = stored.filter(day >= F.col("_first")).select(*arriving.columns)
    kept = later.join(arriving.select(key, "price_date"), [key, "price_date"], "left_anti")
    closes = anchors.unionByName(kept.withColumn("_new", F.lit(False))).unionByName(
        arriving.withColumn("_new", F.lit(True))
    )
    previous = F.lag(price).over(series_window([key]))
    moves = closes.select(
        key, "price_date", F.col(price).alias("new_price"), previous.alias("old_price"), "_new"
    ).filter("_new")
    return alert_records(moves.drop("_new"), now, **thresholds)


def daily_increment(quotes: DataFrame, history: DataFrame, now: Column, **thresholds) -> Increment:
    """Alerts against the state before the load, the rows to store, and the rejected quotes."""
    good, rejects = usable_quotes(quotes)
    prices = quotes_to_prices(good, now)
    return Increment(multi_day_alerts(prices, history, now, **thresholds), prices, rejects)


def recent_alerts(alerts: DataFrame, as_of: date, newest: int = 5, days: int = 3) -> DataFrame:
    """Of the newest alerts by creation time, those of the last days; the limit comes before the filter."""
    return (
        alerts.orderBy(F.desc("created_at"), "alert_id")
        .limit(newest)
        .filter(F.col("alert_date") >= F.date_sub(F.lit(as_of), days))
    )
