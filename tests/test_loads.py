import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from pricemill import domain, schemas
from pricemill.plans import loads
from pricemill.session import run_folder
from pricemill.sources.tables import TableStore

SHEET = "period string, Cocoa double, Iron double"


def test_monthly_sheet_is_merged(spark, make, rows):
    store = TableStore(spark, run_folder(spark, "loads"))
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    later = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    assert loads.load_monthly_sheet(store, make([("2023M12", 1.0, 9.0), ("2024M01", 2.0, 9.0)], SHEET), first) == 2
    assert loads.load_monthly_sheet(store, make([("2024M01", 2.5, 9.0), ("2024M02", 3.0, 9.0)], SHEET), later) == 3
    got = rows(store.read(loads.MONTHLY_RAW), "price_date", "price_usd", "commodity")
    assert got == [("2023M12", "1.0", "cocoa"), ("2024M01", "2.5", "cocoa"), ("2024M02", "3.0", "cocoa")]


def test_monthly_sheet_with_a_unit_line_can_be_loaded_again(spark, make):
    store = TableStore(spark, run_folder(spark, "loads"))
    sheet = make([(None, 1.0, 9.0), ("2024M01", 2.0, 9.0)], SHEET)
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert [loads.load_monthly_sheet(store, sheet, now) for _ in range(3)] == [2, 2, 2]


def test_train_and_publish(spark, make):
    store = TableStore(spark, run_folder(spark, "loads"))
    rng = np.random.default_rng(1)
    columns = ", ".join(f"{f} double" for f in domain.MODEL_FEATURES)
    values = [
        (c, dt.date(2024, 1, 1) + dt.timedelta(days=i), *[float(v) for v in 50 + rng.normal(0, 1, 5)])
        for c, n in (("rice", 60), ("coffee", 45), ("cocoa", 40))
        for i in range(n)
    ]
    store.replace(loads.FEATURES, make(values, "commodity string, price_date date, " + columns))
    errors = {r["commodity"]: r["mape"] for r in loads.train(store).collect()}
    assert set(errors) == {"rice", "coffee"} and all(0 < e < 50 for e in errors.values())
    assert [tuple(r) for r in store.read(loads.SKIPPED).collect()] == [("cocoa", 40)]
    assert loads.publish_forecast(store) and loads.publish_forecast(store)
    published = store.read(loads.FORECAST)
    assert published.count() == 12
    assert [f.name for f in published.schema] == [c.split()[0] for c in schemas.FORECAST.split(", ")]
