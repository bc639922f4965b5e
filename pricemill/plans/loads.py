"""End-to-end loads a user calls: the monthly sheet, and training with a published forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import monthly_sheet_to_raw
from ..schemas import FORECAST as FORECAST_SCHEMA
from ..sources.readers import read_forecast_csv
from ..sources.tables import TableStore, bootstrap, create_table, reload_table
from . import forecast as FC

MONTHLY_RAW = "bronze.wb_prices_raw"
FEATURES = "gold.gold_ml_features"
FORECAST = "gold.forecast_lstm"
MODELS, SCALERS, ERRORS = "ml.window_models", "ml.window_scalers", "ml.holdout_errors"
SKIPPED = "ml.skipped_commodities"


def load_monthly_sheet(store: TableStore, sheet: DataFrame, now: Column) -> int:
    """Merge a wide monthly sheet into the raw table by period, commodity and source; returns its row count."""
    raw = monthly_sheet_to_raw(sheet, now)
    code_year = F.substring("price_date", 1, 4).try_cast("int")
    store.upsert(MONTHLY_RAW, raw, ["price_date", "commodity", "source"], year=code_year)
    return store.count(MONTHLY_RAW)


def train(store: TableStore, commodities: Sequence[str] | None = None, fit_scope: str = "train") -> DataFrame:
    """Fit one model per commodity on the feature mart, store parameters and scaler, return the errors.

    Without a list, every commodity with windows gets a model; those with too short a history are stored in SKIPPED.
    """
    features = store.read(FEATURES)
    # Windows are 30 times as large as the features, so each job makes them again from the stored mart.
    windows = FC.scaled_windows(features, fit_scope)
    keys = windows.select("commodity").distinct()
    store.replace(SKIPPED, features.groupBy("commodity").agg(F.count("*").alias("days")).join(keys, "commodity", "left_anti"))
    models = store.replace(MODELS, FC.fit_window_models(windows, commodities))
    store.replace(SCALERS, FC.window_scaler(windows))
    return store.replace(ERRORS, FC.window_holdout_error(windows, models))


def publish_forecast(store: TableStore) -> bool:
    """Forecast with the stored models and replace the forecast table, unless there is nothing to publish."""
    forecast = FC.window_forecast(store.read(FEATURES), store.read(MODELS), store.read(SCALERS))
    return store.reload(FORECAST, forecast)


def reload_forecast_csv(store: TableStore, layer: str, path: str) -> bool:
    """Load a forecast file into a typed table of the catalog's layer, made if it is absent; a file without rows
    changes nothing. Tells whether rows were loaded."""
    bootstrap(store.spark, [layer])
    table = f"{layer}.forecast_lstm"
    create_table(store.spark, table, FORECAST_SCHEMA, store.path("gold.forecast_typed"))
    return reload_table(store.spark, table, read_forecast_csv(store.spark, path))
