"""Market questions over the serving frame: one row per day and commodity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domain
from ..functions.calendar import month_text
from ..functions.values import FINE, exact_mean, exact_mean_over, label, percent_change
from ..operators.quantiles import exact_quantiles
from ..operators.series import (
    latest_row,
    latest_values,
    series_window,
    trailing,
    with_as_of_metrics,
)

KEY = ["commodity"]


def serving_prices(fact: DataFrame, commodities: DataFrame) -> DataFrame:
    """Fact rows with the commodity's names."""
    names = commodities.select("commodity_id", "name_vi", "category")
    return fact.select(
        "price_date",
        "commodity",
        "commodity_id",
        "price_usd_per_kg",
        "price_change_pct",
        "price_7d_avg",
        "price_30d_avg",
        "source",
        "is_imputed",
    ).join(names, "commodity_id").drop("commodity_id")


def serving_frame(prices: DataFrame, currency: str = "USD") -> DataFrame:
    """Mean price per day and commodity, its 30-observation change and rolling means, in the currency.

    Names depend on the commodity; the smallest non-null one is taken, so that the result does not depend
    on row order.
    """
    grouped = prices.groupBy("price_date", "commodity").agg(
        exact_mean(F.col("price_usd_per_kg")).alias("price_usd_per_kg"),
        F.min("name_vi").alias("name_vi"),
        F.min("category").alias("category"),
    )
    usd = F.col("price_usd_per_kg")
    scale = F.lit(float(domain.USD_TO_VND if currency == "VND" else 1))
    return grouped.withColumns(
        {
            "price_change_pct": percent_change(usd, F.lag(usd, 30).over(series_window(KEY))),
            "price_7d_avg": exact_mean_over(usd, trailing(KEY, 7), FINE),
            "price_30d_avg": exact_mean_over(usd, trailing(KEY, 30), FINE),
        }
    ).withColumns(
        {"price": usd * scale, "price_7d": F.col("price_7d_avg") * scale, "price_30d": F.col("price_30d_avg") * scale}
    )


def date_bounds(df: DataFrame) -> DataFrame:
    """First day, last day, row count and number of commodities of a frame."""
    return df.agg(
        F.min("price_date").alias("min_date"),
        F.max("price_date").alias("max_date"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("commodity").alias("commodities"),
    )


def members(df: DataFrame) -> DataFrame:
    """The commodities of a frame, in order."""
    return df.select("commodity").distinct().orderBy("commodity")


def in_selection(
    df: DataFrame, commodities: Sequence[str], start: date | Column | None = None, end: date | Column | None = None
) -> DataFrame:
    """Rows of the chosen commodities between two days, both included.

    Apply it to a finished serving frame: rolling values at the left edge then still use earlier days.
    """
    kept = df.filter(F.col("commodity").isin(*commodities))
    if start is not None:
        kept = kept.filter(F.col("price_date") >= start)
    if end is not None:
        kept = kept.filter(F.col("price_date") <= end)
    return kept


def last_years(df: DataFrame, years: int, whole: DataFrame) -> DataFrame:
    """Rows of the last n years, counted back from the newest day of the whole data, of which ``df`` is a selection.

    The bound is a scalar subquery, not a join; ``whole`` should be a stored table.
    """
    start = whole.agg(F.greatest(F.min("price_date"), F.add_months(F.max("price_date"), -12 * years))).scalar()
    return df.filter(F.col("price_date") >= start)


def latest_prices(frame: DataFrame) -> DataFrame:
    """The last row of each commodity, with change NULL as 0 in ``abs_change``."""
    return latest_row(frame, KEY).withColumn("abs_change", F.coalesce(F.abs("price_change_pct"), F.lit(0.0)))


def market_pulse(frame: DataFrame) -> DataFrame:
    """Strongest mover, mean absolute move and newest day; equal moves go to the first name."""
    latest = latest_prices(frame)
    strongest = F.min_by(F.struct("commodity", "price_change_pct"), F.struct(-F.col("abs_change"), F.col("commodity")))
    return latest.agg(
        strongest.alias("_s"),
        F.avg("abs_change").alias("avg_move"),
        F.max("price_date").alias("latest_date"),
        F.count(F.lit(1)).alias("commodities"),
    ).select(
        F.col("_s.commodity").alias("strongest"),
        F.col("_s.price_change_pct").alias("strongest_change"),
        "avg_move",
        "latest_date",
        "commodities",
    )


def metric_cards(frame: DataFrame) -> DataFrame:
    return with_as_of_metrics(frame, KEY)


def price_ranking(frame: DataFrame) -> DataFrame:
    """Latest known price per commodity with its label, cheapest first."""
    name = label(F.col("commodity"), domain.DISPLAY_NAMES)
    mark = label(F.col("commodity"), domain.DISPLAY_MARKS, F.lit(""))
    return (
        latest_values(frame, KEY, ["price"])
        .select("commodity", F.concat(mark, F.lit(" "), name).alias("label"), "price")
        .orderBy("price", "commodity")
    )


def yearly_distribution(frame: DataFrame, years_back: int = 10) -> DataFrame:
    """Quartiles, mean and range per commodity and year, for the newest year and the ten before it.

    Quartiles are exact, whatever the number of rows of a group.
    """
    newest = frame.groupBy("commodity").agg(F.max(F.year("price_date")).alias("_newest"))
    dated = frame.withColumn("year", F.year("price_date").cast("long"))
    quartiles = exact_quantiles(dated, ["commodity", "year"], "price", [0.25, 0.5, 0.75]).withColumnRenamed("quantiles", "_q")
    return (
        dated.groupBy("commodity", "year")
        .agg(
            exact_mean(F.col("price"), FINE).alias("mean_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
        .join(quartiles, ["commodity", "year"])
        .join(newest, "commodity")
        .filter(F.col("year") >= F.col("_newest") - years_back)
        .select(
            "commodity",
            "year",
            F.col("_q")[0].alias("q1"),
            F.col("_q")[1].alias("median_price"),
            F.col("_q")[2].alias("q3"),
            "mean_price",
            "min_price",
            "max_price",
        )
    )


def aligned_pair(frame: DataFrame, x: str, y: str) -> DataFrame:
    """Prices of two commodities on the days both have one, from a single pass without a self-join."""
    value = {name: F.max(F.when(F.col("commodity") == c, F.col("price"))) for name, c in (("px", x), ("py", y))}
    return (
        frame.filter(F.col("commodity").isin(x, y))
        .groupBy("price_date")
        .agg(*[v.alias(n) for n, v in value.items()])
        .dropna(subset=["px", "py"])
    )


def pair_correlation(frame: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation of two commodities, its strength band and the least-squares line."""
    strength = F.abs("correlation")
    bands = domain.CORRELATION_BANDS
    return (
        aligned_pair(frame, x, y)
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.corr("px", "py").alias("correlation"),
            F.regr_slope("py", "px").alias("slope"),
            F.regr_intercept("py", "px").alias("intercept"),
            F.min("px").alias("min_x"),
            F.max("px").alias("max_x"),
        )
        .withColumn(
            "strength",
            F.when(strength > 0.7, bands["strong"]).when(strength > 0.4, bands["medium"]).otherwise(bands["weak"]),
        )
    )


def trend_line(correlation: DataFrame, points: int = 100) -> DataFrame:
    """Evenly spaced points of the fitted line between the smallest and largest x."""
    step = (F.col("max_x") - F.col("min_x")) / (points - 1)
    return correlation.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    ).select(
        F.col("point").cast("long").alias("point"),
        (F.col("min_x") + F.col("point") * step).alias("x"),
        (F.col("slope") * (F.col("min_x") + F.col("point") * step) + F.col("intercept")).alias("y"),
    )


def yearly_means(frame: DataFrame, years: int = 4) -> DataFrame:
    """Mean price per commodity in the last n years that have data, rounded half up to cents.

    Means come first, one row per commodity and year; the newest years are then picked from those.
    """
    exact = F.col("price").cast(FINE)
    means = (
        frame.withColumn("year", F.year("price_date").cast("long"))
        .groupBy("year", "commodity")
        .agg(F.sum(exact).alias("_sum"), F.count(exact).alias("_n"))
    )
    newest = means.select("year").distinct().orderBy(F.desc("year")).limit(years)
    mean = F.col("_sum").cast("decimal(28,9)") / F.col("_n").cast("decimal(8,0)")
    return means.join(newest, "year", "left_semi").select(
        "year", "commodity", F.round(mean, 2).cast("decimal(20,2)").alias("mean_price")
    )


def report_table(frame: DataFrame, currency: str = "USD") -> DataFrame:
    """The download table, newest day first; sorted by day, since month text does not sort by time."""
    headers = [h.format(currency=currency) for h in domain.REPORT_HEADERS]
    mark = label(F.col("commodity"), domain.DISPLAY_MARKS, F.lit(""))
    named = F.concat(mark, F.lit(" "), label(F.col("commodity"), domain.DISPLAY_NAMES))
    shown = [
        month_text(F.col("price_date")),
        named,
        F.col("price"),
        F.col("price_change_pct"),
        F.col("price_7d"),
        F.col("price_30d"),
    ]
    ordered = frame.orderBy(F.desc("price_date"), "commodity")
    return ordered.select(*[c.alias(h) for c, h in zip(shown, headers)])


def price_text(price: Column, currency: str = "USD") -> Column:
    """Price for display: whole VND with thousands marks, USD with four decimals."""
    return F.format_number(price, 0) if currency == "VND" else F.format_string("%.4f", price)
