"""Wide monthly sheets to long rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domain
from ..functions.columns import header_for
from ..functions.values import lookup


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per id and value column; rows without a value are dropped."""
    not_a_number = F.coalesce(F.isnan(F.col(value).try_cast("double")), F.lit(False))
    return df.unpivot(list(ids), list(values), name, value).filter(F.col(value).isNotNull() & ~not_a_number)


def resolve_headers(columns: Sequence[str], keywords: Mapping[str, str]) -> dict[str, str]:
    """``header -> commodity`` for the keywords some header contains; the others are left out."""
    found = {header_for(columns, keyword): commodity for keyword, commodity in keywords.items()}
    found.pop(None, None)
    return found


def monthly_sheet_to_raw(
    sheet: DataFrame, now: Column, keywords: Mapping[str, str] = domain.SHEET_KEYWORDS
) -> DataFrame:
    """Raw monthly rows from a wide sheet whose first column is the period.

    A missing period becomes the text ``nan``, so that loading a sheet again replaces such a row; cleaning reads that
    text as no period.
    """
    headers = resolve_headers(sheet.columns, keywords)
    period = sheet.columns[0]
    wide = sheet.select(
        F.coalesce(F.col(f"`{period}`").cast("string"), F.lit(domain.MISSING_PERIOD)).alias("price_date"),
        *[F.col(f"`{h}`").cast("string").alias(h) for h in headers],
    )
    return melt(wide, ["price_date"], list(headers), "original_name", "price_usd").select(
        "price_date",
        "original_name",
        "price_usd",
        lookup(F.col("original_name"), headers).alias("commodity"),
        F.lit(domain.MONTHLY_RAW_SOURCE).alias("source"),
        now.alias("ingested_at"),
    )
