"""Market summary as text lines, for a report or a chat prompt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domain
from ..functions.calendar import month_text
from ..functions.values import label
from ..operators.series import latest_values
from .serving import KEY, yearly_means


def _name(mark: bool = True) -> Column:
    name = label(F.col("commodity"), domain.SUMMARY_NAMES)
    if not mark:
        return name
    return F.concat(label(F.col("commodity"), domain.SUMMARY_MARKS, F.lit("")), F.lit(" "), name)


def _line(section: int, place: Column, text: Column) -> list[Column]:
    return [F.lit(section).alias("section"), place.alias("place"), text.alias("line")]


def summary_lines(frame: DataFrame, currency: str = "USD", top: int = 5, years: int = 4) -> DataFrame:
    """The summary, one row per line, ordered by ``section`` and ``place``."""
    latest = latest_values(frame, KEY, ["price", "price_change_pct"])
    days = frame.agg(F.min("price_date").alias("first_day"), F.max("price_date").alias("last_day"))
    change = F.coalesce("price_change_pct", F.lit(0.0))
    size = F.abs(change)
    none = F.lit(0.0)

    title = days.select(
        *_line(0, none, F.concat(F.lit(domain.SUMMARY_TITLE), month_text(F.col("last_day"))))
    ).filter(F.col("line").isNotNull())
    arrow = F.when(change >= 0, "▲").otherwise("▼")
    moved = F.format_string(
        f"%s: %.4f {currency}/kg  (%s%.2f%% {domain.SUMMARY_VERSUS})", _name(), F.col("price"), arrow, size
    )
    movers = latest.orderBy(size.desc(), "commodity").limit(top).select(*_line(2, -size, moved), "commodity")
    priced = F.format_string(f"  %s: %.4f {currency}/kg", _name(), F.col("price"))
    prices = latest.select(*_line(4, -F.col("price"), priced), "commodity")
    # One entry per commodity and year.
    entries = F.array_sort(
        F.collect_list(F.struct("commodity", F.format_string("%s: %s", _name(False), "mean_price").alias("text")))
    )
    by_year = (
        yearly_means(frame, years)
        .groupBy("year")
        .agg(entries.alias("_entries"))
        .select(
            *_line(
                6,
                F.col("year").cast("double"),
                F.concat(
                    F.lit(domain.SUMMARY_YEAR),
                    F.col("year").cast("string"),
                    F.lit(": "),
                    F.array_join(F.transform("_entries", lambda e: e["text"]), " | "),
                ),
            )
        )
    )
    first_text, last_text = domain.SUMMARY_RANGE
    span = days.select(
        *_line(
            8,
            none,
            F.concat(
                F.lit(first_text), month_text(F.col("first_day")), F.lit(last_text), month_text(F.col("last_day"))
            ),
        )
    ).filter(F.col("line").isNotNull())
    fixed = [
        (1, 0.0, domain.SUMMARY_RULE),
        (3, 0.0, ""),
        (3, 1.0, domain.SUMMARY_ALL),
        (5, 0.0, ""),
        (5, 1.0, domain.SUMMARY_YEARS.format(currency=currency)),
        (7, 0.0, ""),
        *[(9, float(i), text) for i, text in enumerate(domain.SUMMARY_FOOTER)],
    ]
    rows = [F.struct(*_line(s, F.lit(p), F.lit(t)), F.lit("").alias("commodity")) for s, p, t in fixed]
    frame_lines = days.filter(F.col("last_day").isNotNull()).select(F.inline(F.array(*rows)))
    blank = F.lit("").alias("commodity")
    return (
        frame_lines.unionByName(title.withColumn("commodity", blank))
        .unionByName(movers)
        .unionByName(prices)
        .unionByName(by_year.withColumn("commodity", blank))
        .unionByName(span.withColumn("commodity", blank))
    )


def summary_text(frame: DataFrame, currency: str = "USD") -> DataFrame:
    """The summary as one text, with a line for every commodity; a frame without rows says so."""
    lines = F.array_sort(F.collect_list(F.struct("section", "place", "commodity", "line")))
    text = F.array_join(F.transform(lines, lambda e: e["line"]), "\n")
    return summary_lines(frame, currency).agg(
        F.when(F.count(F.lit(1)) == 0, F.lit(domain.SUMMARY_EMPTY)).otherwise(text).alias("summary")
    )
