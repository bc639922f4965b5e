"""Incremental refresh of the daily silver table, the price fact and the feature mart.

A load changes some days of some series. Every metric of a day looks at most a fixed number of rows back, so a series
is made again from its first changed day on, seeded by the rows before it that its windows reach; what lies earlier
is neither computed nor written. Tables are stored by year: a load reads the years from the one that holds the oldest
seed on, and rewrites those from its first changed day on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.series import fill_weekends, latest_per_key
from ..sources.tables import YEAR, TableStore, stored
from . import gold, silver

SILVER, FACT, FEATURES = "silver.silver_yf_prices", "gold.fact_price_daily", "gold.gold_ml_features"
#: Rows before a day that its metrics reach: a mean over 30 rows; a mean over 90 rows and a lag of 30.
FACT_REACH, FEATURE_REACH = 29, 89
FACT_SERIES = ["commodity", "region", "country", "source"]
SERIES = silver.SERIES_KEYS


class UnknownMarket(Exception):
    """A load names a market that the region dimension lacks; the dimension must be built first."""


def first_days(changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First changed day of each series."""
    return changed.groupBy(*keys).agg(F.min("price_date").alias("first_day"))


def seeded(table: DataFrame, firsts: DataFrame, keys: Sequence[str], reach: int) -> DataFrame:
    """Rows of changed series from the reach-th row before their first changed day on; ``first_day`` tells which are
    seeds. ``table`` is stored by year, and only years that can hold seeds are read.

    Years are taken one by one, newest first, until every series has its seeds; only keys are read to find out, and a
    day of the calendar bounds the rounds.
    """
    firsts = stored(table.sparkSession, firsts=firsts)["firsts"]
    bounds = firsts.agg(F.year(F.min("first_day")).alias("first"), F.count("*").alias("series")).first()
    if not bounds.series:
        return table.join(firsts, list(keys)).limit(0)
    oldest = bounds.first
    known = table.filter(F.col(YEAR) < oldest).agg(F.min(YEAR)).first()[0]
    while known is not None and oldest > known:
        oldest -= 1
        # A series that began in these years has no older rows, so its seeds are complete as well.
        early = table.filter((F.col(YEAR) >= oldest) & (F.col(YEAR) <= bounds.first)).select(*keys, "price_date")
        counts = early.join(firsts, list(keys)).filter("price_date < first_day").groupBy(*keys).agg(F.count("*").alias("n"))
        short = firsts.join(counts, list(keys), "left").filter(F.coalesce("n", F.lit(0)) < reach)
        if short.isEmpty():
            break
    rows = table.filter(F.col(YEAR) >= oldest).join(firsts, list(keys))
    behind = Window.partitionBy(*keys, F.col("price_date") < F.col("first_day")).orderBy(F.desc("price_date"))
    place = F.when(F.col("price_date") < F.col("first_day"), F.row_number().over(behind))
    return rows.withColumn("_back", place).filter(F.col("_back").isNull() | (F.col("_back") <= reach)).drop("_back")


def moved(table: DataFrame, changed: DataFrame) -> DataFrame:
    """Series and days that lose a row, since it comes with another country."""
    first = F.lit(changed.agg(F.min("price_date")).first()[0])
    old = table.filter(F.col(YEAR) >= F.year(first)).select(*FACT_SERIES, "price_date")
    now = changed.select(*SERIES, "price_date", F.col("country").alias("_country"))
    return old.join(now, [*SERIES, "price_date"]).filter("country <> _country").select(*FACT_SERIES, "price_date")


def changed_daily(table: DataFrame, observed: DataFrame) -> DataFrame:
    """Silver rows that newly observed prices change: themselves, and the weekend days filled from them or from the
    observation before them. Of old and new loads of a day the newest counts, as in a full build; a missing close that
    was carried from the row before stays as it was stored."""
    firsts = first_days(observed, SERIES)
    old = seeded(table.filter("NOT is_imputed"), firsts, SERIES, 1).drop(YEAR)
    columns = observed.columns
    both = latest_per_key(old.select(*columns).unionByName(observed), silver.DEDUP_KEYS, ["ingested_at", "price_usd_per_kg"])
    filled = fill_weekends(both, SERIES, carry=["close_price"]).join(firsts, SERIES)
    # The seed itself does not change, only days filled from it may be new.
    return filled.filter("price_date >= first_day OR is_imputed").select(*[c for c in table.columns if c != YEAR])


def changed_fact(table: DataFrame, changed: DataFrame, commodities: DataFrame, dates: DataFrame, regions: DataFrame) -> DataFrame:
    """Fact rows from each series' first changed day on; ``changed`` has the silver columns and ``is_imputed``."""
    markets = ["country", "region", "source"]
    changed = changed.select(*gold.PRICE_COLUMNS, "is_imputed")
    unknown = changed.select(*markets).distinct().join(regions, markets, "left_anti")
    if not unknown.isEmpty():
        raise UnknownMarket(str(unknown.limit(5).collect()))
    days = changed.select(*FACT_SERIES, "price_date").unionByName(moved(table, changed))
    firsts = first_days(days, FACT_SERIES)
    old = seeded(table, firsts, FACT_SERIES, FACT_REACH).select(*changed.columns)
    kept = old.join(changed.select(*SERIES, "price_date"), [*SERIES, "price_date"], "left_anti")
    made = gold.priced_series(kept.unionByName(changed), commodities, dates, regions)
    return _from_first(made, firsts, FACT_SERIES)


def changed_features(table: DataFrame, fact: DataFrame, changed: DataFrame, dates: DataFrame) -> DataFrame:
    """Feature rows from each commodity's first changed day on, made from the refreshed fact."""
    firsts = first_days(changed, ["commodity"])
    since = F.year(F.lit(firsts.agg(F.min("first_day")).first()[0]))
    days = fact.filter(F.col(YEAR) >= since).join(firsts, "commodity").filter("price_date >= first_day")
    fresh = gold.daily_across_sources(days, dates)
    old = seeded(table, firsts, ["commodity"], FEATURE_REACH).filter("price_date < first_day")
    return _from_first(gold.with_history(old.select(*fresh.columns).unionByName(fresh)), firsts, ["commodity"])


def _from_first(rows: DataFrame, firsts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(firsts, list(keys)).filter("price_date >= first_day").select(*rows.columns)


def increment(store: TableStore, observed: DataFrame, commodities: DataFrame, dates: DataFrame, regions: DataFrame) -> None:
    """Load cleaned, observed daily prices (of :func:`silver.observed_daily`) into silver, fact and features.

    Each table is merged by key into its years, so a load that is repeated changes nothing. Days outside the calendar
    are left out, as in a full build.
    """
    days = dates.select(F.col("date").alias("price_date"))
    observed = stored(store.spark, observed=observed.join(days, "price_date", "left_semi"))["observed"]
    if observed.isEmpty():
        return
    changed = stored(store.spark, changed=changed_daily(store.read(SILVER), observed))["changed"]
    store.upsert(SILVER, changed, silver.DEDUP_KEYS)
    fresh = changed_fact(store.read(FACT), changed, commodities, dates, regions)
    store.upsert(FACT, fresh, ["price_id", "price_date"])
    mart = changed_features(store.read(FEATURES), store.read(FACT), changed, dates)
    store.upsert(FEATURES, mart, ["commodity", "price_date"])


def by_year(df: DataFrame, day: Column | str = "price_date") -> DataFrame:
    return df.withColumn(YEAR, F.year(day))
