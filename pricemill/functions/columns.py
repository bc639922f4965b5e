"""Column builders that standardise raw quotes: tolerant column choice, defaults, dates, units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import domain
from .values import lookup

_DAY_TEXT = r"^\s*\d{4}[-/]\d{1,2}[-/]\d{1,2}([ T].*|\s*)$"


def choose_column(columns: Sequence[str], candidates: Sequence[str], order: str = "table") -> str | None:
    """Name of the column to use for a logical field, compared without case.

    ``order="table"`` takes the first column of the table that is a candidate; ``order="candidate"``
    takes the first candidate that the table has, also ignoring blanks around names.
    """
    if order == "table":
        wanted = {c.lower() for c in candidates}
        return next((c for c in columns if c.lower() in wanted), None)
    if order == "candidate":
        present = {c.lower().strip(): c for c in columns}
        return next((present[c.lower().strip()] for c in candidates if c.lower().strip() in present), None)
    raise ValueError(f"order must be 'table' or 'candidate', not {order!r}")


def pick(df: DataFrame, candidates: Sequence[str], dtype: str = "string", order: str = "table") -> Column:
    """The chosen column cast leniently, or a typed NULL when the table has none of the candidates."""
    name = choose_column(df.columns, candidates, order)
    if name is None:
        return F.lit(None).cast(dtype)
    return F.col(f"`{name}`").try_cast(dtype)


def header_for(columns: Sequence[str], keyword: str) -> str | None:
    """First header that contains the keyword, ignoring case."""
    return next((c for c in columns if keyword.lower() in c.lower()), None)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def blank_default(c: Column, default: str) -> Column:
    """Trimmed text, or the default for NULL and blank text."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def currency_default(c: Column, default: str = "USD") -> Column:
    return F.coalesce(F.upper(blank_to_null(c)), F.lit(default))


def normalized_text(c: Column) -> Column:
    """Lower-cased trimmed text with NULL as the empty string."""
    return F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))


def day_or_null(c: Column) -> Column:
    """Date from text with year, month and day, separated by ``-`` or ``/``; anything else is NULL.

    A bare year is refused on purpose: Spark's own cast would turn it into January 1st.
    """
    text = c.cast("string")
    return F.when(text.rlike(_DAY_TEXT), F.translate(text, "/", "-").try_cast("date"))


def pick_day(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The chosen column as a date: as it is when it holds dates or times, parsed when it holds text."""
    name = choose_column(df.columns, candidates)
    if name is None:
        return F.lit(None).cast("date")
    typed = isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return F.col(f"`{name}`").cast("date") if typed else day_or_null(F.col(f"`{name}`"))


def _first_of_month(year: Column, month: Column) -> Column:
    """First day of the month; NULL for months and years that do not exist."""
    return F.when(month.between(1, 12) & year.between(1, 9999), F.make_date(year, month, F.lit(1)))


def parse_period(text: Column, year: Column, month: Column) -> Column:
    """First day of a period given as a day, as ``YYYYMmm``, as year and month, or as a year.

    The period code is tried before the day pattern: no text fits both, and the code is the cheaper test.
    """
    is_code = (F.length(text) == 7) & text.contains("M")
    # One short text and one parse; separate numbers for year and month would be cut out of the text again
    # for each test of their range.
    from_code = F.concat(F.substring(text, 1, 4), F.lit("-"), F.trim(F.substring(text, 6, 2)), F.lit("-01"))
    whole_year = _first_of_month(year, F.lit(1))
    by_parts = F.when(month.between(1, 12), _first_of_month(year, month)).otherwise(whole_year)
    return F.when(is_code, from_code.try_cast("date")).otherwise(F.coalesce(day_or_null(text), by_parts))


def _any_like(c: Column, patterns: Sequence[str]) -> Column:
    hit = c.like(patterns[0])
    for pattern in patterns[1:]:
        hit = hit | c.like(pattern)
    return hit


def monthly_price_per_kg(commodity: Column, unit: Column, price: Column) -> Column:
    """USD per kg of a monthly quote. Rice is always quoted per tonne; otherwise the unit text decides."""
    amount = price.cast("double")
    unit_text = F.lower(F.coalesce(unit, F.lit("")))
    per_tonne = (commodity == "rice") | _any_like(unit_text, ["%ton%", "%/mt%", "%/t%"]) | unit_text.isin("t", "mt")
    return (
        F.when(per_tonne, amount / 1000)
        .when(unit_text.like("%lb%"), amount / domain.LB_TO_KG)
        .otherwise(amount)
    )


def daily_price_per_kg(per_kg: Column, unit: Column, ticker: Column, close: Column) -> Column:
    """USD per kg of a daily quote. A price already per kg wins; else contract unit or ticker decides."""
    amount = close.cast("double")
    unit_text = F.lower(F.coalesce(unit, F.lit("")))
    by_rule = (
        F.when((unit_text == "cents/lb") | ticker.isin("KC=F", "CT=F"), amount / 100 / domain.LB_TO_KG)
        .when((unit_text == "cents/cwt") | (ticker == "ZR=F"), amount / 100 / domain.CWT_TO_KG)
        .when(unit_text.isin("usd/metric_ton", "usd/mt") | (ticker == "CC=F"), amount / 1000)
    )
    return F.coalesce(per_kg.cast("double"), by_rule)


def contract_price_per_kg(commodity: Column, close: Column) -> Column:
    """USD per kg at ingest, by commodity; NULL for a commodity without a contract.

    Rice is scaled from rough rice per hundredweight to milled rice, which differs from the rule in
    :func:`daily_price_per_kg`; the ingest value takes precedence there.
    """
    return (
        F.when(commodity.isin("coffee", "cotton"), close / 100.0 / domain.LB_TO_KG)
        .when(commodity == "cocoa", close / 1000.0)
        .when(commodity == "rice", close / domain.CWT_TO_KG * domain.MILLED_RICE_FACTOR)
    )


def commodity_id(commodity: Column) -> Column:
    return lookup(commodity, domain.COMMODITY_IDS)


def is_harvest_season(commodity: Column, month: Column) -> Column:
    """Whether the month belongs to the commodity's harvest; season lists may wrap the year end."""
    hit = F.lit(False)
    for name, months in domain.HARVEST_MONTHS.items():
        hit = hit | ((commodity == name) & month.isin(months))
    return F.coalesce(hit, F.lit(False))


def is_domestic_market(country: Column) -> Column:
    return F.coalesce(F.lower(country).isin(domain.DOMESTIC_COUNTRIES), F.lit(False))
