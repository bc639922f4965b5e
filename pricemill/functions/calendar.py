"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import domain


def day_of_week(d: Column) -> Column:
    """Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def is_public_holiday(d: Column) -> Column:
    return F.date_format(d, "MM-dd").isin(domain.HOLIDAYS)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_text(d: Column) -> Column:
    return F.date_format(d, "MM/yyyy")


def calendar_columns(d: Column) -> dict[str, Column]:
    """Columns of the date dimension. ``week`` is the ISO week while ``year`` is the calendar year."""
    return {
        "date_id": F.date_format(d, "yyyyMMdd").cast("int"),
        "date": d,
        "year": F.year(d).cast("long"),
        "quarter": F.quarter(d).cast("long"),
        "month": F.month(d).cast("long"),
        "month_name": F.date_format(d, "MMMM"),
        "week": F.weekofyear(d).cast("long"),
        "day_of_week": day_of_week(d).cast("long"),
        "is_weekend": is_weekend(d),
        "is_vietnam_public_holiday": is_public_holiday(d),
    }
