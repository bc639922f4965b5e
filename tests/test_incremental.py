import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pricemill.plans import gold, incremental, silver
from pricemill.session import run_folder
from pricemill.sources.readers import read_mapping
from pricemill.sources.tables import YEAR, TableStore

RAW = "price_date date, price_usd double, price_usd_per_kg double, commodity string, ticker string, raw_unit string, currency string, region string, country string, ingested_at timestamp_ntz"
MONTHLY = "period string, Item string, value double, Market string, country string, loaded_at timestamp_ntz"
SCOPE = ["rice", "coffee", "cocoa"]
START = dt.date(2019, 1, 1)


def now():
    return F.lit("2024-06-01 12:00:00").cast("timestamp_ntz")


def quote(rng, day, commodity, region, loaded, country="United States"):
    return (day.isoformat(), 1.0, round(rng.uniform(1, 9), 2), commodity, "T", "kg", "USD", region, country, f"2024-01-{loaded:02d} 00:00:00")


@pytest.fixture(scope="module")
def raw():
    """First load, and a second one with new days, late days in the middle, corrections, another country for known
    days, and the same day in a series whose rows lie years apart."""
    rng = random.Random(1)
    first, second = [], []
    for commodity, region, gap in (("rice", "A", 1), ("rice", "B", 4), ("coffee", "A", 2), ("cocoa", "S", 61)):
        days = [START + dt.timedelta(days=d) for d in range(0, 1100, gap)]
        for d in days:
            late = commodity == "rice" and region == "A" and d.month == 3 and d.year == 2020
            (second if d >= dt.date(2021, 6, 1) or late else first).append(quote(rng, d, commodity, region, 1))
    second += [quote(rng, dt.date(2020, 1, d), "rice", "B", 2) for d in (9, 13)]
    second += [quote(rng, START + dt.timedelta(days=2 * d), "coffee", "A", 3, "Viet Nam") for d in (300, 301)]
    second += [quote(rng, START + dt.timedelta(days=61 * 9), "cocoa", "S", 2)]
    second += [quote(rng, dt.date(2030, 1, 1), "rice", "A", 2)]  # outside the calendar
    return first, second


@pytest.fixture
def world(spark, make, raw):
    rng = random.Random(2)
    monthly = [(f"{y}M{m:02d}", "Coffee, Arabica", round(rng.uniform(1, 9), 2), "m", "World", "2024-01-01 00:00:00") for y in (2019, 2020, 2021, 2022) for m in range(1, 13)]
    mapping = read_mapping(spark)
    dates = gold.dim_date(spark, dt.date(2022, 1, 1), dt.date(2019, 1, 1), dt.date(2022, 12, 31))
    month = silver.clean_monthly(make(monthly, MONTHLY), mapping, now(), SCOPE)
    load = lambda rows: make(rows, RAW)
    commodities = gold.dim_commodity(mapping)
    whole = silver.clean_daily(load(raw[0] + raw[1]), mapping, dates, now(), SCOPE)
    before = silver.clean_daily(load(raw[0]), mapping, dates, now(), SCOPE)
    regions = gold.dim_region(month, before.unionByName(whole))

    def build(daily):
        store = TableStore(spark, run_folder(spark, "world"))
        silver_table = store.replace(incremental.SILVER, incremental.by_year(daily), [YEAR])
        fact = gold.fact_price_daily(month, silver_table, commodities, dates, regions)
        fact = store.replace(incremental.FACT, incremental.by_year(fact), [YEAR])
        store.replace(incremental.FEATURES, incremental.by_year(gold.gold_ml_features(fact, dates)), [YEAR])
        return store

    observe = lambda rows: silver.observed_daily(load(rows), mapping, now(), SCOPE)
    return build, before, whole, observe, (commodities, dates, regions)


def content(store, name):
    df = store.read(name)
    return sorted(tuple(str(round(v, 9) if isinstance(v, float) else v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_increments_equal_a_full_build(world, raw):
    build, first, whole, observe, dims = world
    full, store = build(whole), build(first)
    untouched = [f for f in store.read(incremental.FACT).inputFiles() if f"{YEAR}=2019" in f]
    rows = sorted(raw[1], key=lambda r: (r[9], r[0]))
    # Two loads and an empty one, and then all of it once more, which changes nothing.
    for parts in ((rows[:150], rows[150:], []), (rows,)):
        for part in parts:
            incremental.increment(store, observe(part), *dims)
        for name in (incremental.SILVER, incremental.FACT, incremental.FEATURES):
            assert content(store, name) == content(full, name), name
    assert untouched and set(untouched) <= set(store.read(incremental.FACT).inputFiles())


def test_only_years_with_seeds_are_read(world, raw):
    build, first, _, observe, dims = world
    store = build(first)
    late = observe([r for r in raw[1] if r[0] >= "2021-06-01" and r[3] == "rice" and r[7] == "A"])
    changed = incremental.changed_daily(store.read(incremental.SILVER), late)
    fact = incremental.changed_fact(store.read(incremental.FACT), changed, *dims)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert f"{YEAR}" in plan and ">= 2021" in plan
    days = {r[0] for r in fact.select(F.min("price_date")).collect()}
    assert min(days) >= dt.date(2021, 5, 31)


def test_unknown_market_needs_a_build(world):
    build, first, _, observe, dims = world
    store = build(first)
    rng = random.Random(3)
    with pytest.raises(incremental.UnknownMarket):
        incremental.increment(store, observe([quote(rng, dt.date(2021, 7, 1), "rice", "new", 4)]), *dims)
