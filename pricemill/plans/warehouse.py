"""The warehouse as named models: what each reads, how it is built, which checks it must pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import domain
from ..operators.quality import (
    ROWS,
    Check,
    accepted,
    not_null,
    relationship,
    row_measures,
    run_checks,
    run_key_checks,
    unique,
    unique_combination,
)
from ..sources.tables import YEAR, TableStore, qualified_name
from . import gold, silver

ALL_COMMODITIES = list(domain.COMMODITY_IDS)
SERIES_DAY = ("commodity", "price_date", "region", "source")


@dataclass(frozen=True)
class Settings:
    """What a build depends on besides the raw tables."""

    as_of: date
    now: Column
    calendar_start: date = date.fromisoformat(domain.CALENDAR_START)
    calendar_end: date = date.fromisoformat(domain.CALENDAR_END)
    scope: Sequence[str] = field(default_factory=lambda: domain.PRICE_SCOPE)


@dataclass(frozen=True)
class Model:
    layer: str
    reads: tuple[str, ...]
    build: Callable[[SparkSession, Mapping[str, DataFrame], Settings], DataFrame]
    checks: tuple[Check, ...] = ()
    by_year: bool = False


MODELS: dict[str, Model] = {
    "dim_date": Model(
        "gold",
        (),
        lambda spark, t, s: gold.dim_date(spark, s.as_of, s.calendar_start, s.calendar_end),
        (unique("date_id"), not_null("date_id"), unique("date"), not_null("date")),
    ),
    "dim_commodity": Model(
        "gold",
        ("commodity_mapping",),
        lambda spark, t, s: gold.dim_commodity(t["commodity_mapping"]),
        (
            unique("commodity_id"),
            not_null("commodity_id"),
            unique("commodity"),
            not_null("commodity"),
            accepted("commodity", ALL_COMMODITIES),
        ),
    ),
    "silver_wb_prices": Model(
        "silver",
        ("wb_prices_raw", "commodity_mapping"),
        lambda spark, t, s: silver.clean_monthly(t["wb_prices_raw"], t["commodity_mapping"], s.now, s.scope),
        (
            unique_combination(*SERIES_DAY),
            not_null("commodity"),
            accepted("commodity", ALL_COMMODITIES),
            not_null("price_date"),
            not_null("region"),
            not_null("price_usd_per_kg"),
            not_null("source"),
            accepted("source", [domain.MONTHLY_SOURCE]),
        ),
    ),
    "silver_yf_prices": Model(
        "silver",
        ("yf_prices_raw", "commodity_mapping", "dim_date"),
        lambda spark, t, s: silver.clean_daily(
            t["yf_prices_raw"], t["commodity_mapping"], t["dim_date"], s.now, s.scope
        ),
        (
            unique_combination(*SERIES_DAY),
            not_null("commodity"),
            accepted("commodity", domain.PRICE_SCOPE),
            not_null("price_date"),
            not_null("region"),
            not_null("price_usd_per_kg"),
            not_null("source"),
            accepted("source", [domain.DAILY_SOURCE]),
        ),
        by_year=True,
    ),
    "dim_region": Model(
        "gold",
        ("silver_wb_prices", "silver_yf_prices"),
        lambda spark, t, s: gold.dim_region(t["silver_wb_prices"], t["silver_yf_prices"]),
        (
            unique_combination("country", "region", "source"),
            unique("region_id"),
            not_null("region_id"),
            not_null("country"),
            not_null("region"),
            not_null("source"),
        ),
    ),
    "fact_price_daily": Model(
        "gold",
        ("silver_wb_prices", "silver_yf_prices", "dim_commodity", "dim_date", "dim_region"),
        lambda spark, t, s: gold.fact_price_daily(
            t["silver_wb_prices"], t["silver_yf_prices"], t["dim_commodity"], t["dim_date"], t["dim_region"]
        ),
        (
            unique("price_id"),
            not_null("price_id"),
            not_null("commodity_id"),
            relationship("commodity_id", "dim_commodity", "commodity_id"),
            not_null("date_id"),
            relationship("date_id", "dim_date", "date_id"),
            not_null("region_id"),
            relationship("region_id", "dim_region", "region_id"),
            not_null("price_usd_per_kg"),
            not_null("source"),
            accepted("source", [domain.MONTHLY_SOURCE, domain.DAILY_SOURCE]),
        ),
        by_year=True,
    ),
    "gold_ml_features": Model(
        "gold",
        ("fact_price_daily", "dim_date"),
        lambda spark, t, s: gold.gold_ml_features(t["fact_price_daily"], t["dim_date"]),
        (
            unique_combination("price_date", "commodity"),
            not_null("price_date"),
            not_null("commodity"),
            accepted("commodity", ALL_COMMODITIES),
            not_null("price_usd_per_kg"),
        ),
        by_year=True,
    ),
    "gold_monthly_combined": Model(
        "gold",
        ("silver_wb_prices", "silver_yf_prices"),
        lambda spark, t, s: gold.gold_monthly_combined(t["silver_wb_prices"], t["silver_yf_prices"]),
    ),
}


class ChecksFailed(Exception):
    """Raised when a model's checks find rows; models that read it are not built."""


def build_order(select: Iterable[str] | None = None) -> list[str]:
    """Models in dependency order; ``select`` names models or layers to keep."""
    graph = {name: [r for r in model.reads if r in MODELS] for name, model in MODELS.items()}
    order = list(TopologicalSorter(graph).static_order())
    if select is None:
        return order
    wanted = set(select)
    return [n for n in order if n in wanted or MODELS[n].layer in wanted]


def check_models(tables: Mapping[str, DataFrame], names: Iterable[str] | None = None) -> DataFrame:
    """All checks of the given models, one row per check."""
    chosen = [n for n in (names or build_order()) if MODELS[n].checks]
    reports = [run_checks(n, tables[n], MODELS[n].checks, dict(tables)) for n in chosen]
    return reduce(DataFrame.unionByName, reports)


def build(
    store: TableStore,
    sources: Mapping[str, DataFrame],
    settings: Settings,
    select: Iterable[str] | None = None,
    stop_on_failure: bool = True,
) -> DataFrame:
    """Build the selected models as stored tables, each checked before the models that read it.

    ``sources`` holds the raw tables and the mapping. Models that are read but not selected are taken
    from the store. Returns the check report: model, check, violations.
    """
    tables = dict(sources)
    results = []
    chosen = build_order(select)
    for name in chosen:
        model = MODELS[name]
        for read in model.reads:
            if read not in tables:
                tables[read] = store.read(f"{MODELS[read].layer}.{read}")
        built = model.build(store.spark, tables, settings)
        table = qualified_name(name, model.layer)
        if model.by_year:
            built = built.withColumn(YEAR, F.year("price_date"))
        # Row checks are counted by the job that writes the rows; only keys need another look at the table.
        measures = row_measures(model.checks)
        tables[name], counted = store.replace_measured(table, built, [YEAR] if model.by_year else [], measures)
        found = [(name, title, n) for title, n in counted.items() if title != ROWS]
        keyed = run_key_checks(name, tables[name], model.checks, tables)
        # One short row per declared check.
        found += [tuple(r) for r in keyed.collect()] if keyed is not None else []
        results += found
        broken = [f"{check}: {violations}" for _, check, violations in found if violations]
        if broken and stop_on_failure:
            raise ChecksFailed(f"{name}: " + "; ".join(broken))
    return store.spark.createDataFrame(results, "model string, check string, violations long")
