"""Price-like raw tables derived from the supplied benchmark tables.

``orders`` gives daily quotes: the priority is the raw commodity name, the status the market, the total
price the price. ``lineitem`` joined with ``orders`` gives monthly quotes by return flag. Raw names,
blanks and period codes are spelled as messy sources do, so the cleaning steps have work to do.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.values import lookup
from ..operators.lookups import built_in_aliases
from ..plans import gold, serving, silver
from ..session import run_folder
from .readers import read_mapping
from .tables import folder_exists, stored

#: Spelling of the commodity name in the raw daily and monthly rows, by order priority.
DAILY_NAMES = {
    "1-URGENT": " Paddy ",
    "2-HIGH": "CA PHE",
    "3-MEDIUM": "cacao",
    "4-NOT SPECIFIED": "Cotton",
    "5-LOW": "natural rubber",
}
MONTHLY_NAMES = {
    "1-URGENT": "Rice, Thai 5%",
    "2-HIGH": "Coffee, Arabica",
    "3-MEDIUM": "Cocoa",
    "4-NOT SPECIFIED": "Cotton, A Index",
    "5-LOW": "Rubber",
}
SCOPE = ["rice", "coffee", "cocoa", "cotton", "rubber"]
AS_OF = date(2001, 8, 1)
LOADED_FROM = "2002-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loaded_at(seconds: Column) -> Column:
    """Load time as a fixed start plus a number of seconds taken from the row's keys."""
    whole = seconds.cast("long")
    days, rest = (whole / 86400).cast("int"), (whole % 86400).cast("decimal(8,0)")
    return F.lit(LOADED_FROM).cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)


def now() -> Column:
    return F.lit("2003-01-01 00:00:00").cast("timestamp_ntz")


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return orders.select(
        F.to_date("o_orderdate").alias("price_date"),
        price.alias("price_usd"),
        price.alias("price_usd_per_kg"),
        lookup(F.col("o_orderpriority"), DAILY_NAMES).alias("commodity"),
        F.lit("yahoo_finance").alias("source"),
        F.lit(" ").alias("ticker"),
        F.lit("unit_contract").alias("raw_unit"),
        F.lit(" usd ").alias("currency"),
        F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus")).alias("region"),
        F.when(F.col("o_orderstatus") == "F", "Viet Nam").otherwise("").alias("country"),
        loaded_at(F.col("o_orderkey")).alias("ingested_at"),
    )


def raw_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    items = table(spark, sf_dir, "lineitem")
    # Rice is quoted per tonne.
    quoted = F.col("l_extendedprice") * F.when(F.col("o_orderpriority") == "1-URGENT", 1000).otherwise(1)
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.date_format("l_shipdate", "yyyy'M'MM").alias("period"),
        lookup(F.col("o_orderpriority"), MONTHLY_NAMES).alias("Item"),
        quoted.alias("value"),
        F.col("l_returnflag").alias("Market"),
        loaded_at(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("loaded_at"),
    )


_YEARS: dict[tuple[str, str], tuple[int, int]] = {}


def years(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last year of all dated rows, looked up once per application, since the supplied tables don't change."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _YEARS:
        _YEARS[key] = _scanned_years(spark, sf_dir)
    return _YEARS[key]


def _scanned_years(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("d"))
    days = days.unionAll(table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("d")))
    ends = days.agg(F.year(F.min("d")).alias("first"), F.year(F.max("d")).alias("last")).first()
    return ends.first or AS_OF.year, ends.last or AS_OF.year


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole years around all dated rows, and the year after them."""
    first, last = years(spark, sf_dir)
    return gold.dim_date(spark, date(last, 1, 1), date(first, 1, 1), date(last + 1, 12, 31))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_daily(raw_daily(spark, sf_dir), built_in_aliases(), calendar(spark, sf_dir), now(), SCOPE)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_monthly(raw_monthly(spark, sf_dir), built_in_aliases(), now(), SCOPE)


def silver_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Monthly and daily prices, stored, since dimensions and facts both read them."""
    tables = stored(spark, monthly=monthly(spark, sf_dir), daily=daily(spark, sf_dir))
    return tables["monthly"], tables["daily"]


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, d = silver_tables(spark, sf_dir)
    # Stored, so that its measured size decides about a broadcast: it has a few rows, but its plan reads all prices.
    regions = stored(spark, regions=gold.dim_region(m, d))["regions"]
    return gold.fact_price_daily(m, d, gold.dim_commodity(read_mapping(spark)), calendar(spark, sf_dir), regions)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_ml_features(fact(spark, sf_dir), calendar(spark, sf_dir))


_FACTS: dict[tuple[str, str], tuple[str, StructType]] = {}


def built_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as serving queries find it: built and stored by the first of them, read by all, once per application.
    It is built again if its folder has been cleared away."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FACTS or not folder_exists(spark, f"{_FACTS[key][0]}/_SUCCESS"):
        path, built = run_folder(spark, "fact"), fact(spark, sf_dir)
        built.write.parquet(path)
        _FACTS[key] = path, built.schema
    path, schema = _FACTS[key]
    return spark.read.schema(schema).parquet(path)


def frame(spark: SparkSession, sf_dir: str, currency: str = "USD") -> DataFrame:
    prices = serving.serving_prices(built_fact(spark, sf_dir), gold.dim_commodity(read_mapping(spark)))
    return serving.serving_frame(prices, currency)


def closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily price per commodity and day over all markets: the last one loaded."""
    observed = silver.observed_daily(raw_daily(spark, sf_dir), built_in_aliases(), now(), SCOPE)
    newest = F.max(F.struct("ingested_at", "price_usd_per_kg")).alias("_last")
    return (
        observed.groupBy("commodity", "price_date")
        .agg(newest)
        .select("commodity", "price_date", F.col("_last.price_usd_per_kg").cast("double").alias("price_usd_per_kg"))
    )
