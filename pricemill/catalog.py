"""The registered queries: each takes a session and the folder of the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import domain, schemas
from .functions import columns as C
from .functions.calendar import calendar_columns
from .functions.values import label, lookup
from .operators import quality as Q
from .operators import series as S
from .operators.lookups import built_in_aliases, previous_close, resolve_alias
from .operators.reshape import melt, monthly_sheet_to_raw
from .operators.scaling import apply_min_max, fit_min_max, unscaled
from .operators.sequences import training_windows, with_minimum_history
from .operators.upsert import keyed_upsert, replace_day_slice, with_missing_columns
from .plans import alerts as A
from .plans import forecast as FC
from .plans import gold, incremental, loads, serving, silver, summary, warehouse
from .session import run_folder
from .sources import driver_tables as D
from .sources.readers import read_mapping, read_monthly_sheet, stream_quotes
from .sources.tables import YEAR, TableStore, stored
from .streaming import increments, keyed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(value: Column, digits: int = 4) -> Column:
    """Round half up with plain floating-point steps, which every engine repeats bit by bit."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("double") / scale


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as longs, for results that other engines are compared with."""
    casts = {}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind.startswith("decimal"):
            casts[f.name] = F.col(f.name).cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            casts[f.name] = F.col(f.name).cast("long")
    return df.withColumns(casts) if casts else df


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.observed_daily(D.raw_daily(spark, sf_dir), built_in_aliases(), D.now(), D.SCOPE)


# --- Cleaning ---


@query
def tolerant_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns found under one of several names, in table order or in candidate order."""
    events = D.table(spark, sf_dir, "events")
    missing = C.pick(events, ["price", "close"], "decimal(18,6)")
    return doubles(
        events.select(
            "event_id",
            C.pick(events, ["VALUE", "Event_Type"]).alias("by_table_order"),
            C.pick(events, [" value ", "event_type"], "decimal(18,6)", order="candidate").alias("by_candidate_order"),
            C.pick(events, ["props"], "double").isNull().alias("uncastable_is_null"),
            missing.isNull().alias("absent_is_null"),
        )
    )


@query
def parse_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates spelled in several ways, by order priority and status, and read back."""
    orders = D.table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(day, "yyyy'M'MM"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(day, "yyyy/M/d"))
        .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "F"), "2024M13")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "nan")
    )
    year = F.when(F.col("o_orderstatus") != "P", F.year(day))
    month = F.when(F.col("o_orderstatus") == "O", F.month(day) + 3)
    spelled = orders.select("o_orderkey", text.alias("t"), year.alias("y"), month.alias("m"))
    return spelled.select("o_orderkey", C.parse_period(F.col("t"), F.col("y"), F.col("m")).alias("price_date"))


@query
def unit_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item prices in units named after the part type, converted by the monthly, daily and contract rules."""
    parts = D.table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    items = D.table(spark, sf_dir, "lineitem")
    monthly_units = {"ECONOMY": "USD/Ton", "STANDARD": "$/mt", "MEDIUM": "T", "LARGE": "US$/lb", "SMALL": "kg"}
    daily_units = {"ECONOMY": "cents/lb", "STANDARD": "Cents/cwt", "MEDIUM": "USD/MT", "LARGE": "bushel"}
    tickers = {"LARGE": "CC=F", "SMALL": "KC=F"}
    commodity = F.when(F.col("p_size") < 10, "rice").when(F.col("p_size") < 20, "coffee").when(
        F.col("p_size") < 30, "cocoa"
    )
    per_kg = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice") / 4)
    quoted = items.join(parts, items.l_partkey == parts.p_partkey).withColumns(
        {
            "commodity": commodity,
            "m_unit": lookup(F.col("p_type"), monthly_units),
            "d_unit": lookup(F.col("p_type"), daily_units),
            "ticker": lookup(F.col("p_type"), tickers),
            "per_kg": per_kg,
        }
    )
    price = F.col("l_extendedprice")
    return quoted.select(
        "l_orderkey",
        "l_partkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        C.monthly_price_per_kg(F.col("commodity"), F.col("m_unit"), price).alias("monthly_price"),
        C.daily_price_per_kg(F.col("per_kg"), F.col("d_unit"), F.col("ticker"), price).alias("daily_price"),
        C.contract_price_per_kg(F.col("commodity"), price).alias("contract_price"),
    )


@query
def blank_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults for blank text, currency codes and normalised text."""
    events = D.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    messy = (
        F.when(kind == "view", "  ")
        .when(kind == "error", "")
        .when(kind == "click", " Eur ")
        .when(kind != "signup", kind)
    )
    return events.select(
        "event_id",
        C.blank_default(messy, domain.DAILY_REGION).alias("region"),
        C.currency_default(messy).alias("currency"),
        C.normalized_text(messy).alias("plain"),
    )


@query
def melt_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four measures of a line item as rows, zero taken as missing, totalled per measure and return flag."""
    items = D.table(spark, sf_dir, "lineitem")
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    names = {"l_quantity": "quantity", "l_extendedprice": "price", "l_discount": "discount", "l_tax": "tax"}
    wide = items.select("l_returnflag", *[F.nullif(F.col(m), F.lit(0.0)).alias(m) for m in measures])
    return doubles(
        melt(wide, ["l_returnflag"], measures, "original_name", "value")
        .groupBy("l_returnflag", lookup(F.col("original_name"), names).alias("measure"))
        .agg(F.count(F.lit(1)).alias("value_count"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
    )


@query
def wide_sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monthly sheet with one padded column per commodity, resolved by keyword and melted."""
    orders = D.table(spark, sf_dir, "orders")
    headers = {
        "1-URGENT": "RICE, THAI 5% ",
        "2-HIGH": "Coffee, Arabica",
        "3-MEDIUM": "Cocoa beans",
        "4-NOT SPECIFIED": "Iron ore",
        "5-LOW": "Cotton, A Index",
    }
    sheet = (
        orders.groupBy(F.date_format("o_orderdate", "yyyy'M'MM").alias("Unnamed"))
        .agg(*[F.max(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice"))).alias(h) for p, h in headers.items()])
    )
    raw = monthly_sheet_to_raw(sheet.toDF(*[c.strip() for c in sheet.columns]), D.now())
    return raw.select(
        "price_date", "original_name", F.col("price_usd").cast("double").alias("price_usd"), "commodity", "source"
    )


@query
def alias_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw commodity names of orders joined to the mapping table."""
    orders = D.table(spark, sf_dir, "orders")
    names = {**D.DAILY_NAMES, "5-LOW": " Soy Beans "}
    raw = orders.select("o_orderkey", lookup(F.col("o_orderpriority"), names).alias("raw_name"))
    return resolve_alias(raw, "raw_name", read_mapping(spark)).select("o_orderkey", "raw_name", "commodity")


@query
def latest_load_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quotes after validation: the latest load per day, commodity and market."""
    return doubles(_observed(spark, sf_dir)).select(
        "commodity",
        "price_date",
        "region",
        "country",
        "price_usd_per_kg",
        "currency",
        "unit",
        "ticker",
        "source",
        F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"),
    )


@query
def clean_monthly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(D.monthly(spark, sf_dir)).withColumn(
        "ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss")
    )


# --- Calendar ---


@query
def calendar_fill_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned daily prices with weekend days filled."""
    return doubles(D.daily(spark, sf_dir)).withColumn(
        "ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss")
    )


@query
def calendar_fill_every_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of every series, filled forward without a limit; NULL closes take the previous one."""
    observed = _observed(spark, sf_dir).select("commodity", "region", "price_date", "price_usd_per_kg")
    close = F.when(F.dayofweek("price_date") != 3, F.col("price_usd_per_kg"))
    filled = S.fill_calendar(observed.withColumn("close_price", close), ["commodity", "region"], carry=["close_price"])
    return doubles(filled)


@query
def series_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.series_bounds(_observed(spark, sf_dir), ["commodity", "region", "country", "source"])


@query
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar attributes with the number of orders of each day."""
    per_day = (
        D.table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    dates = D.calendar(spark, sf_dir).join(per_day, "date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))
    return doubles(dates)


@query
def date_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar columns computed on ship dates."""
    days = D.table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(
        F.count(F.lit(1)).alias("items")
    )
    return doubles(days.select("items", *[c.alias(n) for n, c in calendar_columns(F.col("d")).items()]))


@query
def rows_outside_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations that a calendar starting in 1996 drops."""
    dates = gold.dim_date(spark, D.AS_OF, date(1996, 1, 1), date(2000, 12, 31), lookahead_days=-200)
    return silver.outside_calendar(_observed(spark, sf_dir), dates)


# --- Star schema and marts ---


@query
def rolling_price_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous price, change and rolling means per commodity and market."""
    series = ["commodity", "region"]
    prices = _observed(spark, sf_dir).select(*series, "price_date", "price_usd_per_kg")
    metrics = S.with_previous(prices, series, "price_usd_per_kg")
    return doubles(S.with_rolling_means(metrics, series, "price_usd_per_kg", {"price_7d_avg": 7, "price_30d_avg": 30}))


@query
def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(D.fact(spark, sf_dir)).withColumn(
        "ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss")
    )


@query
def region_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_region(*D.silver_tables(spark, sf_dir))


@query
def commodity_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commodities with the number of daily observations of each."""
    dims = gold.dim_commodity(read_mapping(spark))
    counts = _observed(spark, sf_dir).groupBy("commodity").agg(F.count(F.lit(1)).alias("observations"))
    joined = dims.join(counts, "commodity", "left").withColumn("observations", F.coalesce("observations", F.lit(0)))
    return doubles(joined)


@query
def mapping_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the mapping read from a CSV file, for the names as well as for the dimension."""
    path = run_folder(spark, "mapping")
    read_mapping(spark).write.option("header", True).csv(path)
    mapping = read_mapping(spark, path)
    observed = silver.observed_daily(D.raw_daily(spark, sf_dir), mapping, D.now(), D.SCOPE)
    counts = observed.groupBy("commodity").agg(F.count(F.lit(1)).alias("observations"))
    joined = gold.dim_commodity(mapping).join(counts, "commodity", "left")
    return doubles(joined.withColumn("observations", F.coalesce("observations", F.lit(0))))


@query
def cross_source_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = ["price_change_pct", "price_7d_avg", "price_30d_avg"]
    daily = gold.daily_across_sources(D.fact(spark, sf_dir), D.calendar(spark, sf_dir))
    return doubles(daily).withColumns({c: rounded(F.col(c)) for c in means})


@query
def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    inexact = ["price_change_pct", "price_7d_avg", "price_30d_avg", "price_30d_volatility"]
    return doubles(D.features(spark, sf_dir)).withColumns({c: rounded(F.col(c)) for c in inexact})


def _incremented(spark: SparkSession, sf_dir: str) -> tuple[TableStore, DataFrame]:
    """The warehouse built without the orders from June 2000 on and without the rice of 1999, which then come as an
    increment; with the calendar."""
    day, late_rice = F.col("price_date"), (F.col("commodity") == " Paddy ") & (F.year("price_date") == 1999)
    second = (day >= "2000-06-01") | F.coalesce(late_rice, F.lit(False))
    raw = D.raw_daily(spark, sf_dir)
    mapping, dates = built_in_aliases(), D.calendar(spark, sf_dir)
    tables = stored(
        spark,
        monthly=D.monthly(spark, sf_dir),
        whole=D.daily(spark, sf_dir),
        first=silver.clean_daily(raw.filter(~second), mapping, dates, D.now(), D.SCOPE),
        second=silver.observed_daily(raw.filter(second), mapping, D.now(), D.SCOPE),
    )
    store = TableStore(spark, run_folder(spark, "increment"))
    commodities = gold.dim_commodity(read_mapping(spark))
    regions = stored(spark, regions=gold.dim_region(tables["monthly"], tables["whole"]))["regions"]
    daily = store.replace(incremental.SILVER, incremental.by_year(tables["first"]), [YEAR])
    fact = gold.fact_price_daily(tables["monthly"], daily, commodities, dates, regions)
    fact = store.replace(incremental.FACT, incremental.by_year(fact), [YEAR])
    store.replace(incremental.FEATURES, incremental.by_year(gold.gold_ml_features(fact, dates)), [YEAR])
    incremental.increment(store, tables["second"], commodities, dates, regions)
    return store, dates


@query
def incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after a load and an increment with late days: equal to the one that is built at once."""
    store, _ = _incremented(spark, sf_dir)
    fact = doubles(store.read(incremental.FACT).drop(YEAR))
    return fact.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))


@query
def incremental_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature mart after the same increment."""
    store, _ = _incremented(spark, sf_dir)
    inexact = ["price_change_pct", "price_7d_avg", "price_30d_avg", "price_30d_volatility"]
    return doubles(store.read(incremental.FEATURES).drop(YEAR)).withColumns({c: rounded(F.col(c)) for c in inexact})


@query
def monthly_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(gold.gold_monthly_combined(*D.silver_tables(spark, sf_dir)))


# --- Serving ---


@query
def serving_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.frame(spark, sf_dir, "VND")


@query
def frame_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First day, last day, rows and number of commodities of the serving frame."""
    return serving.date_bounds(D.frame(spark, sf_dir))


@query
def frame_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commodities to choose from, with their display names."""
    found = serving.members(D.frame(spark, sf_dir))
    return found.select("commodity", label(F.col("commodity"), domain.DISPLAY_NAMES).alias("name"))


@query
def filtered_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three chosen commodities in the last three years of all data, up to a day."""
    frame = _stored_frame(spark, sf_dir)
    chosen = serving.in_selection(frame, ["rice", "coffee", "rubber"], end=date(2001, 6, 30))
    return serving.last_years(chosen, 3, frame).select("price_date", "commodity", "price", "price_30d")


@query
def latest_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per commodity, with its change as it stands."""
    return serving.latest_prices(D.frame(spark, sf_dir)).select(
        "commodity", "price_date", "price", "price_change_pct", "abs_change"
    )


@query
def latest_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type the latest value that is not missing, column by column."""
    events = D.table(spark, sf_dir, "events").select(
        "event_type",
        "ts",
        F.when(F.col("value") >= 20, F.col("value")).alias("high_value"),
        F.when(F.col("user_id") > 100, F.col("user_id")).alias("late_user"),
        F.when(F.col("value") < 0, F.col("value")).alias("negative_value"),
    )
    latest = S.latest_values(events, ["event_type"], ["high_value", "late_user", "negative_value"], "ts")
    return latest.withColumn("negative_value", F.col("negative_value").isNotNull()).withColumnRenamed(
        "negative_value", "has_negative"
    )


@query
def last_rows_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 24 closes of each commodity."""
    return S.last_rows(D.closes(spark, sf_dir), ["commodity"], 24)


@query
def strongest_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    pulse = serving.market_pulse(D.frame(spark, sf_dir))
    return pulse.withColumns({c: rounded(F.col(c)) for c in ["strongest_change", "avg_move"]})


@query
def top_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest moves of the latest rows."""
    latest = serving.latest_prices(D.frame(spark, sf_dir))
    return latest.orderBy(F.desc("abs_change"), "commodity").limit(3).select("commodity", "price", "abs_change")


@query
def metric_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.metric_cards(D.frame(spark, sf_dir))


@query
def price_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.price_ranking(D.frame(spark, sf_dir))


@query
def yearly_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box summary of the newest year and the ten before it."""
    return serving.yearly_distribution(_stored_frame(spark, sf_dir))


@query
def pair_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = serving.pair_correlation(D.frame(spark, sf_dir), "rice", "coffee")
    digits = {"correlation": 6, "slope": 6, "intercept": 2}
    return pair.withColumns({c: rounded(F.col(c), n) for c, n in digits.items()})


@query
def trend_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = serving.pair_correlation(D.frame(spark, sf_dir), "cocoa", "cotton")
    return serving.trend_line(pair).withColumns({"x": rounded(F.col("x"), 3), "y": rounded(F.col("y"), 3)})


@query
def displayed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of the latest rows as a page shows them, in both currencies."""
    latest = serving.latest_prices(D.frame(spark, sf_dir))
    return latest.select(
        "commodity",
        serving.price_text(F.col("price")).alias("usd"),
        serving.price_text(F.col("price") * domain.USD_TO_VND, "VND").alias("vnd"),
    )


@query
def yearly_means_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(serving.yearly_means(D.frame(spark, sf_dir)))


@query
def report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = serving.report_table(D.frame(spark, sf_dir))
    return table.toDF("month", "commodity", "price", "change_pct", "avg_7", "avg_30")


@query
def report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table exported as CSV and read back."""
    names = ["month", "commodity", "price", "change_pct", "avg_7", "avg_30"]
    folder = run_folder(spark, "export")
    store = TableStore(spark, folder)
    store.export_csv(serving.report_table(D.frame(spark, sf_dir)), f"{folder}/report")
    schema = ", ".join(f"{n} {'string' if n in ('month', 'commodity') else 'double'}" for n in names)
    return spark.read.schema(schema).option("header", True).csv(f"{folder}/report")


def _stored_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving frame, stored, since each section of the summary reads it."""
    return stored(spark, frame=D.frame(spark, sf_dir))["frame"]


@query
def summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = summary.summary_lines(_stored_frame(spark, sf_dir))
    return lines.select(F.col("section").cast("long").alias("section"), "commodity", "line")


@query
def summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.summary_text(_stored_frame(spark, sf_dir))


# --- Incremental load and alerts ---


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as two loads, by price, with an unknown market for some and one column more in the second."""
    orders = D.table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("price_date"),
        F.col("o_orderpriority").alias("commodity"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("source"),
        F.col("o_totalprice").alias("price_usd"),
        F.col("o_orderkey").alias("load_key"),
        (F.col("o_totalprice") >= 250000).alias("_second"),
    )
    existing = orders.filter(~F.col("_second")).drop("_second")
    return existing, orders.filter("_second").drop("_second").withColumn("ticker", F.lit("T"))


@query
def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second load merged into the first by day, commodity and market; unknown markets match nothing."""
    existing, incoming = _halves(spark, sf_dir)
    merged = keyed_upsert(existing, incoming, ["price_date", "commodity", "source"])
    return with_missing_columns(merged, {"region": "string"}).withColumn("region", F.col("region").isNull())


@query
def day_slice_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second load replacing whole days of a commodity, whatever the market."""
    existing, incoming = _halves(spark, sf_dir)
    return replace_day_slice(existing, incoming.drop("ticker"))


@query
def stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a stored table by year, loaded twice to show that a repeat changes nothing."""
    existing, incoming = _halves(spark, sf_dir)
    store = TableStore(spark, run_folder(spark, "upsert"))
    keys = ["price_date", "commodity"]
    store.upsert("bronze.prices", existing, keys)
    for _ in range(2):
        store.upsert("bronze.prices", incoming, keys)
    columns = ["price_date", "commodity", "source", "price_usd", "load_key", "ticker"]
    return store.read("bronze.prices").select(*columns)


@query
def monthly_sheet_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest item price by month and commodity as a wide CSV sheet, with line breaks in quoted cells and in the title,
    loaded twice into the raw table; with the row count after the second load."""
    monthly = D.raw_monthly(spark, sf_dir)
    sheet_names = [h for h in domain.SHEET_KEYWORDS]
    price = F.round(F.max("value"), 2).cast("decimal(18,2)").cast("string")
    wide = monthly.groupBy("period").pivot("Item", sheet_names).agg(price)
    note = F.concat(F.lit('"month ""'), F.col("period"), F.lit('""\n'), F.substring("period", 1, 4), F.lit(',\nend"'))
    cells = [F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in sheet_names]
    body = wide.select(F.concat_ws(",", "period", note, *cells).alias("value"), F.col("period").alias("at"))
    header = ",".join(["", '"Notes\nof the sheet"', *[f'"{n} "' for n in sheet_names]])
    first = ['"Prices, ""nominal""\nand real"', "monthly", "", "updated", header, ",,($/kg),($/mt),($/kg),($/kg)"]
    top = spark.createDataFrame([(v, f" {i}") for i, v in enumerate(first)], "value string, at string")
    path = run_folder(spark, "sheet")
    # One file: the sheet has a row for each month.
    top.unionByName(body).coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    store = TableStore(spark, run_folder(spark, "sheets"))
    sheet = read_monthly_sheet(spark, path)
    counts = [loads.load_monthly_sheet(store, sheet, D.now()) for _ in range(2)]
    loaded = store.read(loads.MONTHLY_RAW).filter(F.col("price_date") != domain.MISSING_PERIOD)
    return loaded.select(
        "price_date",
        "commodity",
        F.trim("original_name").alias("original_name"),
        F.col("price_usd").cast("double").alias("price_usd"),
        F.lit(counts[0] == counts[1]).alias("repeatable"),
        F.lit(counts[1]).cast("long").alias("stored_rows"),
    )


@query
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second load merged by commodity, day, region and market into a bucketed table, loaded twice."""
    region = F.concat(F.lit("R"), (F.col("load_key") % 3).cast("string"))
    existing, incoming = (load.withColumn("region", region) for load in _halves(spark, sf_dir))
    store = TableStore(spark, run_folder(spark, "bucketed"))
    keys = ["commodity", "price_date", "region", "source"]
    known = incoming.filter("source IS NOT NULL")
    store.upsert_bucketed("bronze.prices", existing, keys, 16)
    for _ in range(2):
        store.upsert_bucketed("bronze.prices", known, keys, 16)
    columns = ["price_date", "commodity", "region", "source", "price_usd", "load_key", "ticker"]
    return spark.table(store.view("bronze.prices")).select(*columns)


@query
def previous_close_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest close of each commodity before a day."""
    return previous_close(D.closes(spark, sf_dir), F.lit("2000-06-17").cast("date"))


def _alert_view(alerts: DataFrame) -> DataFrame:
    return alerts.drop("created_at").withColumn("pct_change", rounded(F.col("pct_change"), 6))


@query
def threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the price history as if loaded that day."""
    return _alert_view(A.alert_records(A.successive_moves(D.closes(spark, sf_dir)), D.now()))


@query
def appended_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same alerts appended year by year to a table that is made empty first; with the row count after the load."""
    alerts = stored(spark, alerts=A.alert_records(A.successive_moves(D.closes(spark, sf_dir)), D.now()))["alerts"]
    store = TableStore(spark, run_folder(spark, "appended"))
    store.clone_empty("bronze.price_alerts", alerts)
    first, last = D.years(spark, sf_dir)
    for year in range(first, last + 1):
        store.append("bronze.price_alerts", alerts.filter(F.year("alert_date") == year))
    table = store.read("bronze.price_alerts", schemas.PRICE_ALERTS)
    return _alert_view(table).withColumn("stored_rows", F.lit(store.count("bronze.price_alerts")).cast("long"))


@query
def single_day_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's load against the stored history."""
    closes = D.closes(spark, sf_dir)
    return _alert_view(A.threshold_alerts(closes, closes, date(2001, 3, 15), D.now()))


@query
def alerts_for_late_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of several years against the history before it, each day compared with the day before its own."""
    tables = stored(spark, closes=D.closes(spark, sf_dir))
    closes = tables["closes"]
    first = F.lit("1999-03-01").cast("date")
    history, incoming = closes.filter(F.col("price_date") < first), closes.filter(F.col("price_date") >= first)
    return _alert_view(A.multi_day_alerts(incoming, history, D.now()))


@query
def recent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest alerts of the history, limited before the date filter."""
    found = A.alert_records(A.successive_moves(D.closes(spark, sf_dir)), D.now())
    created = F.col("alert_date").cast("timestamp_ntz")
    newest = A.recent_alerts(found.withColumn("created_at", created), D.AS_OF, newest=5, days=3)
    return newest.select("alert_id", "alert_date", "commodity", "threshold")


@query
def quote_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes made from events, converted per contract, and the unusable ones with their reason."""
    good, rejects = A.usable_quotes(_event_quotes(spark, sf_dir))
    kept = good.select(
        "ticker", "commodity", "quoted_on", C.contract_price_per_kg(F.col("commodity"), F.col("close")).alias("price")
    ).withColumn("reject_reason", F.lit(None).cast("string"))
    rejected = rejects.select(
        "ticker", "commodity", "quoted_on", F.lit(None).cast("double").alias("price"), "reject_reason"
    )
    both = kept.unionByName(rejected)
    return both.withColumns(
        {
            "commodity": F.coalesce("commodity", F.lit("")),
            "ticker": F.coalesce("ticker", F.lit("")),
            "reject_reason": F.coalesce("reject_reason", F.lit("")),
        }
    )


def _event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickers = {"view": "KC=F", "click": "ZR=F", "purchase": "CC=F", "signup": "CT=F", "error": "XX=F"}
    return D.table(spark, sf_dir, "events").select(
        lookup(F.col("event_type"), tickers).alias("ticker"),
        F.when(F.col("value") >= 5, F.col("value")).alias("close"),
        F.to_date("ts").alias("quoted_on"),
    )


@query
def stream_daily_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes of orders landed in three waves and loaded by a stream; the alerts it stored."""
    tickers = {c: t for t, c in domain.TICKERS.items()}
    closes = stored(spark, closes=D.closes(spark, sf_dir))["closes"]
    quotes = closes.select(
        lookup(F.col("commodity"), tickers).alias("ticker"),
        F.col("price_usd_per_kg").alias("close"),
        F.col("price_date").alias("quoted_on"),
    )
    folder = run_folder(spark, "increments")
    store = TableStore(spark, f"{folder}/tables")
    landing = f"{folder}/landing"
    day = F.col("quoted_on")
    wave = F.when(day < "1999-01-01", 0).when(day >= "2001-01-01", 2).when(day >= "1999-01-01", 1).otherwise(0)
    for number in range(3):
        quotes.filter(wave == number).write.mode("append").json(landing)
        stream = increments.quote_stream(stream_quotes(spark, landing), store, f"{folder}/state", D.now)
        stream.awaitTermination()
    return _alert_view(store.read(increments.ALERTS)).drop("price_year")


def _keyed_stream(spark: SparkSession, sf_dir: str) -> TableStore:
    """Closes landed in three waves and loaded by the stream with keyed state.

    The first of a month lands twice. The second and third wave bring the last twenty days before them again: some
    too late, those of odd days repeated, those of even days corrected.
    """
    tickers = {c: t for t, c in domain.TICKERS.items()}
    closes = stored(spark, closes=D.closes(spark, sf_dir))["closes"]
    day = F.col("price_date")
    wave = F.when(day < "1999-01-01", 0).when(day >= "2001-01-01", 2).otherwise(1)
    base = closes.withColumn("wave", wave).withColumn("close", F.col("price_usd_per_kg"))
    twice = base.filter(F.dayofmonth(day) == 1)
    next_wave = F.when(F.col("wave") == 0, F.lit("1999-01-01").cast("date")).when(F.col("wave") == 1, F.lit("2001-01-01").cast("date"))
    again = base.filter(day >= F.date_sub(next_wave, 20)).withColumns(
        {"wave": F.col("wave") + 1, "close": F.when(F.dayofmonth(day) % 2 == 0, F.col("close") * 1.05).otherwise(F.col("close"))}
    )
    landed = stored(spark, landed=base.unionByName(twice).unionByName(again))["landed"]
    quotes = landed.select("wave", lookup(F.col("commodity"), tickers).alias("ticker"), "close", day.alias("quoted_on"))
    folder = run_folder(spark, "keyed")
    store = TableStore(spark, f"{folder}/tables")
    for number in range(3):
        quotes.filter(F.col("wave") == number).drop("wave").write.mode("append").json(f"{folder}/landing")
        stream = keyed.keyed_quote_stream(stream_quotes(spark, f"{folder}/landing"), store, f"{folder}/state", D.now)
        stream.awaitTermination()
    return store


@query
def stream_state_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the keyed stream accepted: the last close of each commodity and day."""
    prices = keyed.current_prices(_keyed_stream(spark, sf_dir))
    return prices.select("commodity", "price_date", "price_usd", "price_usd_per_kg", "ticker", F.col("batch").alias("wave"))


@query
def stream_state_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Its alerts, those of corrected closes among them."""
    return _alert_view(_keyed_stream(spark, sf_dir).read(keyed.ALERTS)).drop("load_id")


@query
def stream_state_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated, late and unusable quotes, with their numbers."""
    rejects = _keyed_stream(spark, sf_dir).read(keyed.REJECTS)
    named = rejects.withColumns({c: F.coalesce(c, F.lit("")) for c in ("commodity", "ticker")})
    return named.groupBy("commodity", "ticker", "quoted_on", "close", "reject_reason").agg(F.sum("quotes").alias("quotes"))


# --- Forecast ---


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes with the lag features, NULL at the start of each series."""
    price = F.col("price_usd_per_kg")
    lags = S.with_lags(
        D.closes(spark, sf_dir), ["commodity"], "price_usd_per_kg", {"price_lag_1": 1, "price_lag_7": 7}
    )
    means = S.with_rolling_means(lags, ["commodity"], "price_usd_per_kg", {"price_30d_avg": 30})
    return means.withColumn("price_30d_volatility", F.stddev_samp(price).over(S.trailing(["commodity"], 30)))


@query
def backfill_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes of Mondays and Tuesdays removed, then filled from the next and the previous day."""
    gaps = D.closes(spark, sf_dir).withColumn(
        "price_usd_per_kg", F.when(~F.dayofweek("price_date").isin(2, 3), F.col("price_usd_per_kg"))
    )
    return S.filled_both_ways(gaps, ["commodity"], ["price_usd_per_kg"])


@query
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes and a constant scaled per commodity, and scaled back."""
    closes = D.closes(spark, sf_dir).withColumn("constant", F.lit(7.0))
    features = ["price_usd_per_kg", "constant"]
    params = fit_min_max(closes, "commodity", features)
    scaled = apply_min_max(closes, params, "commodity", features)
    return scaled.select(
        "commodity",
        "price_date",
        rounded(F.col("price_usd_per_kg"), 8).alias("scaled_price"),
        F.col("constant").alias("scaled_constant"),
        rounded(unscaled(F.col("price_usd_per_kg"), "price_usd_per_kg"), 3).alias("price"),
        unscaled(F.col("constant"), "constant").alias("constant"),
    )


@query
def training_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of thirty rows with the next price as target, a row for each of their steps."""
    filled = FC.filled_features(_features(spark, sf_dir), ["price_usd_per_kg", "price_lag_1", "price_lag_7"])
    enough = with_minimum_history(filled, ["commodity"], domain.TRAIN_MIN_ROWS_ABOVE + 1)
    windows = training_windows(
        enough, ["commodity"], ["price_usd_per_kg", "price_lag_7"], domain.SEQUENCE_LENGTH, "price_usd_per_kg"
    )
    steps = windows.select("commodity", "price_date", "window_no", "target", "is_train", F.posexplode("steps").alias("step", "row"))
    return steps.select(
        "commodity",
        "price_date",
        "window_no",
        (F.col("step") + 1).cast("long").alias("step"),
        F.get("row", F.lit(0)).alias("price"),
        F.get("row", F.lit(1)).alias("lag_7"),
        "target",
        "is_train",
    )


@query
def ar1_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = ["predicted_price", "ci_lower", "ci_upper"]
    return FC.ar1_forecast(D.closes(spark, sf_dir)).withColumns({c: rounded(F.col(c), 3) for c in prices})


@query
def forecast_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast as CSV, loaded into a typed table; a file without rows, loaded next, changes nothing."""
    folder = run_folder(spark, "forecast")
    store = TableStore(spark, folder)
    forecast = FC.ar1_forecast(D.closes(spark, sf_dir))
    layer = f"gold_{uuid.uuid4().hex[:12]}"
    for part, rows in (("full", forecast), ("empty", forecast.limit(0))):
        store.export_csv(rows, f"{folder}/{part}")
        loads.reload_forecast_csv(store, layer, f"{folder}/{part}")
    prices = ["predicted_price", "ci_lower", "ci_upper"]
    return spark.table(f"{layer}.forecast_lstm").withColumns({c: rounded(F.col(c), 3) for c in prices})


@query
def forecast_mape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FC.ar1_holdout_error(D.closes(spark, sf_dir)).withColumn("mape", rounded(F.col("mape")))


def _history(closes: DataFrame) -> DataFrame:
    return closes.withColumn("price", F.col("price_usd_per_kg") * domain.USD_TO_VND)


@query
def forecast_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = stored(spark, closes=D.closes(spark, sf_dir))["closes"]
    line = FC.history_and_forecast(_history(closes), FC.ar1_forecast(closes), currency="VND")
    return line.withColumns({c: rounded(F.col(c), 0) for c in ["price", "ci_lower", "ci_upper"]})


@query
def forecast_insight(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = stored(spark, closes=D.closes(spark, sf_dir))["closes"]
    insight = FC.forecast_insight(_history(closes), FC.ar1_forecast(closes), currency="VND")
    digits = {"forecast_price": 0, "change_pct": 4}
    return insight.withColumns({c: rounded(F.col(c), n) for c, n in digits.items()})


def _windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Features, stored, and their scaled windows, which are 30 times as large and made again by each job."""
    features = stored(spark, features=_features(spark, sf_dir))["features"]
    return features, FC.scaled_windows(features)


@query
def scaler_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted scalers of all rows and of those that training windows see, with the windows of each commodity."""
    features = stored(spark, features=_features(spark, sf_dir))["features"]

    def fitted(scope: str) -> DataFrame:
        bounds = [F.max(f"{f}_{b}").alias(f"{f}_{b}") for f in domain.MODEL_FEATURES for b in ("min", "range")]
        windows = FC.scaled_windows(features, scope)
        counts = [F.count("*").alias("windows"), F.sum(F.col("is_train").cast("long")).alias("train_windows")]
        return windows.groupBy("commodity").agg(*counts, *bounds).withColumn("fit_scope", F.lit(scope))

    both = fitted("train").unionByName(fitted("all"))
    return both.withColumns({c: rounded(F.col(c), 3) for c in both.columns if c.endswith(("_min", "_range"))})


@query
def window_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of the regressions over whole windows, one row for each weight."""
    _, windows = _windows(spark, sf_dir)
    models = FC.fit_window_models(windows)
    return models.select("commodity", rounded(F.col("intercept"), 6).alias("intercept"), F.posexplode("weights").alias("cell", "weight")).select(
        "commodity", "intercept", F.col("cell").cast("long").alias("cell"), rounded(F.col("weight"), 6).alias("weight")
    )


@query
def window_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training windows of each commodity, and the gradient of the ridge objective at the fitted parameters."""
    _, windows = _windows(spark, sf_dir)
    models = stored(spark, models=FC.fit_window_models(windows))["models"]
    found = FC.window_fit(windows, models)
    return found.withColumns({c: rounded(F.col(c), 6) for c in ("steepest", "bias")})


@query
def mllib_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast of regressions over whole windows, with the parameters that MLlib's ridge regression has."""
    features, windows = _windows(spark, sf_dir)
    models = FC.fit_window_models(windows)
    forecast = FC.window_forecast(features, models, FC.window_scaler(windows))
    return forecast.withColumns({c: rounded(F.col(c), 0) for c in ("predicted_price", "ci_lower", "ci_upper")})


@query
def mllib_holdout_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of the same models on the held-out windows."""
    _, windows = _windows(spark, sf_dir)
    return FC.window_holdout_error(windows, FC.fit_window_models(windows)).withColumn("mape", rounded(F.col("mape")))


@query
def published_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored mart, models trained on it, and the forecast they publish, twice; with the stored holdout error."""
    store = TableStore(spark, run_folder(spark, "published"))
    store.replace(loads.FEATURES, _features(spark, sf_dir))
    loads.train(store)
    for _ in range(2):
        loads.publish_forecast(store)
    forecast = store.read(loads.FORECAST).join(store.read(loads.ERRORS).select("commodity", "mape"), "commodity")
    prices = {c: rounded(F.col(c), 0) for c in ("predicted_price", "ci_lower", "ci_upper")}
    return forecast.withColumns({**prices, "mape": rounded(F.col("mape"))})


# --- Data quality ---


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a kind that has no user on record here."""
    events = D.table(spark, sf_dir, "events").withColumn("user_id", F.when(F.col("value") >= 1, F.col("user_id")))
    return Q.violations(events, Q.not_null("user_id")).select("event_id", "event_type")


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys that several line items carry, NULL keys left aside."""
    items = D.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_quantity") > 5, F.col("l_orderkey")).alias("l_orderkey")
    )
    return Q.violations(items, Q.unique("l_orderkey"))


@query
def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = D.table(spark, sf_dir, "orders")
    return Q.violations(orders, Q.accepted("o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])).select(
        "o_orderkey", "o_orderpriority"
    )


@query
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer is not among those with a positive balance."""
    customers = D.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    check = Q.relationship("o_custkey", "customer", "c_custkey")
    return Q.violations(D.table(spark, sf_dir, "orders"), check, {"customer": customers}).select(
        "o_orderkey", "o_custkey"
    )


@query
def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = D.table(spark, sf_dir, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
    return Q.violations(items, Q.unique_combination("l_orderkey", "l_linenumber"))


@query
def warehouse_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole warehouse built as stored tables from the supplied ones; the report of all declared checks."""
    return warehouse.build(*_warehouse(spark, sf_dir), stop_on_failure=False)


@query
def warehouse_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same build, which stops where a check finds rows: rubber is outside the scope of the daily prices. Which
    models were built."""
    store, sources, settings = _warehouse(spark, sf_dir)
    try:
        warehouse.build(store, sources, settings)
    except warehouse.ChecksFailed:
        pass
    built = [(n, store.exists(f"{m.layer}.{n}")) for n, m in warehouse.MODELS.items()]
    return spark.createDataFrame(built, "model string, built boolean")


def _warehouse(spark: SparkSession, sf_dir: str) -> tuple[TableStore, dict[str, DataFrame], warehouse.Settings]:
    first, last = D.years(spark, sf_dir)
    sources = {
        "yf_prices_raw": D.raw_daily(spark, sf_dir),
        "wb_prices_raw": D.raw_monthly(spark, sf_dir),
        "commodity_mapping": read_mapping(spark),
    }
    settings = warehouse.Settings(
        as_of=date(last, 1, 1),
        now=D.now(),
        calendar_start=date(first, 1, 1),
        calendar_end=date(last + 1, 12, 31),
        scope=D.SCOPE,
    )
    return TableStore(spark, run_folder(spark, "warehouse")), sources, settings
