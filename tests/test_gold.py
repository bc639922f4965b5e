import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricemill import domain, schemas
from pricemill.plans import gold, silver, warehouse
from pricemill.session import run_folder
from pricemill.sources.readers import read_mapping
from pricemill.sources.tables import TableStore


def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


@pytest.fixture(scope="module")
def raw_daily(make):
    rows = []
    start = dt.date(2024, 1, 1)
    for ticker, commodity in domain.TICKERS.items():
        for i in range(60):
            day = start + dt.timedelta(days=i)
            if day.weekday() < 5:
                rows.append((day, 100.0 + i, 1.0 + i / 100, commodity.upper(), "yahoo_finance", ticker, "unit_contract",
                             "usd", "", None, "2024-05-01 00:00:00"))
    rows.append((start, 1.0, 9.0, "rice", "yahoo_finance", "ZR=F", "u", "usd", "", None, "2024-05-02 00:00:00"))
    rows.append((start, 1.0, 9.0, "tea", "yahoo_finance", "TT=F", "u", "usd", "", None, "2024-05-02 00:00:00"))
    rows.append((start, 1.0, -1.0, "cocoa", "yahoo_finance", "CC=F", "u", "usd", "", None, "2024-05-02 00:00:00"))
    rows.append(("1999-12-31", 1.0, 1.0, "cocoa", "yahoo_finance", "CC=F", "u", "usd", "", None, "2024-05-02 00:00:00"))
    return make(rows, schemas.BRONZE_DAILY)


@pytest.fixture(scope="module")
def raw_monthly(make):
    return make(
        [
            ("2024M01", "Rice, Thai 5%", "600", "rice", "world_bank_pink_sheet", "2024-05-01 00:00:00"),
            ("2024M02", "Rice, Thai 5%", "610", "rice", "world_bank_pink_sheet", "2024-05-01 00:00:00"),
            ("2024M02", "Cocoa", "5.5", "cocoa", "world_bank_pink_sheet", "2024-05-01 00:00:00"),
            ("2024M02", "Cocoa", "n/a", "cocoa", "world_bank_pink_sheet", "2024-05-09 00:00:00"),
            ("nan", "Cocoa", "($/kg)", "cocoa", "world_bank_pink_sheet", "2024-05-01 00:00:00"),
        ],
        schemas.BRONZE_MONTHLY,
    )


@pytest.fixture(scope="module")
def dates(spark):
    return gold.dim_date(spark, dt.date(2024, 6, 1))


def test_calendar_size(spark):
    assert gold.dim_date(spark, dt.date(2024, 6, 1)).count() == 9862
    longer = gold.dim_date(spark, dt.date(2026, 6, 1))
    assert longer.agg(F.max("date")).first()[0] == dt.date(2027, 6, 6)


def test_clean_monthly(spark, raw_monthly, rows):
    out = silver.clean_monthly(raw_monthly, read_mapping(spark), now())
    assert rows(out.withColumn("p", F.col("price_usd_per_kg").cast("double")), "commodity", "price_date", "region", "country", "p", "unit") == [
        ("cocoa", "2024-02-01", "global", "World", 5.5, "kg"),
        ("rice", "2024-01-01", "global", "World", 0.6, "kg"),
        ("rice", "2024-02-01", "global", "World", 0.61, "kg"),
    ]
    assert out.schema["price_usd_per_kg"].dataType.simpleString() == "decimal(18,6)"


def test_clean_daily(spark, raw_daily, dates, rows):
    out = silver.clean_daily(raw_daily, read_mapping(spark), dates, now())
    per = {r["commodity"]: r for r in out.groupBy("commodity").agg(F.count("*").alias("n"), F.count_if("is_imputed").alias("f")).collect()}
    assert set(per) == set(domain.PRICE_SCOPE)
    # 44 weekdays and 16 weekend days from 1 January to 29 February; all weekends lie between weekdays.
    assert all(r["n"] == 60 and r["f"] == 16 for r in per.values())
    first = out.filter("commodity = 'rice' and price_date = '2024-01-01'").first()
    assert float(first["price_usd_per_kg"]) == 9.0
    assert out.filter("region != 'US futures market' or country != 'United States' or currency != 'USD'").isEmpty()
    lost = silver.outside_calendar(silver.observed_daily(raw_daily, read_mapping(spark), now()), dates)
    assert rows(lost, "commodity", "dropped_rows") == [("cocoa", 1)]


def test_region_numbers_equal_global_ranking(make, rows):
    markets = [("World", "global", "W"), ("Viet Nam", "z", "Y"), ("viet nam", "a", "Y"), ("Viet Nam", "b", "Y"), ("Chad", "q", "W")]
    columns = "country string, region string, source string"
    out = gold.dim_region(make(markets[:3] + markets[:1], columns), make(markets[3:], columns))
    ranked = [(i + 1, *m) for i, m in enumerate(sorted(markets))]
    assert rows(out, "region_id", "country", "region", "source") == ranked
    assert {r[0] for r in rows(out.filter("is_vietnam_market"), "country")} == {"Viet Nam", "viet nam"}


def test_commodity_dimension(spark, rows):
    assert rows(gold.dim_commodity(read_mapping(spark)), "commodity_id", "commodity") == sorted(
        (i, c) for c, i in domain.COMMODITY_IDS.items()
    )


def test_build_and_checks(spark, raw_daily, raw_monthly, rows):
    store = TableStore(spark, run_folder(spark, "warehouse"))
    sources = {"yf_prices_raw": raw_daily, "wb_prices_raw": raw_monthly, "commodity_mapping": read_mapping(spark)}
    settings = warehouse.Settings(as_of=dt.date(2024, 6, 1), now=now())
    report = warehouse.build(store, sources, settings)
    assert report.count() == 47
    assert report.filter("violations > 0").isEmpty()
    fact = store.read("gold.fact_price_daily")
    assert fact.count() == 4 * 60 + 3
    key = "YAHOO_FINANCE|rice|2024-01-02|US futures market"
    row = fact.filter(F.col("price_id") == F.md5(F.lit(key))).first()
    assert float(row["previous_price_usd_per_kg"]) == 9.0 and row["date_id"] == 20240102
    assert row["price_7d_avg"] == (9.0 + 1.01) / 2
    features = store.read("gold.gold_ml_features")
    both = features.filter("commodity = 'rice' and price_date = '2024-02-01'").first()
    assert both["source_count"] == 2 and both["price_usd_per_kg"] == pytest.approx((1.31 + 0.61) / 2)
    assert features.filter("commodity = 'rice'").orderBy("price_date").first()["price_30d_volatility"] is None
    monthly = store.read("gold.gold_monthly_combined")
    assert monthly.count() == 3 + 8
    assert {r[0] for r in rows(monthly.filter("commodity = 'coffee'"), "source")} == {"YAHOO_FINANCE_MONTHLY_AVG"}
    # A partial build takes what it reads from the store.
    again = warehouse.build(store, sources, settings, select=["gold_ml_features"])
    assert again.count() == 5


def test_build_order_and_stop(spark, raw_daily, raw_monthly):
    order = warehouse.build_order()
    for name, model in warehouse.MODELS.items():
        assert all(order.index(r) < order.index(name) for r in model.reads if r in order)
    assert set(warehouse.build_order(["silver"])) == {"silver_wb_prices", "silver_yf_prices"}
    store = TableStore(spark, run_folder(spark, "warehouse"))
    settings = warehouse.Settings(as_of=dt.date(2024, 6, 1), now=now(), scope=["rice", "tea"])
    sources = {"yf_prices_raw": raw_daily, "wb_prices_raw": raw_monthly, "commodity_mapping": read_mapping(spark)}
    with pytest.raises(warehouse.ChecksFailed, match="silver_yf_prices.*accepted"):
        warehouse.build(store, sources, settings)
    with pytest.raises(Exception):
        store.read("gold.fact_price_daily")
