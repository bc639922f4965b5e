"""Forecasting data flow: feature matrix, fit per commodity, recursive prediction, band, evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import domain
from ..functions.values import percent_change
from ..operators.scaling import apply_min_max, scale_columns, span, unscaled
from ..operators.sequences import training_windows, with_minimum_history
from ..operators.series import filled_both_ways, last_rows, series_window
from ..operators.window_regression import ridge_by_group, ridge_gradient, window_sums

KEY = "commodity"
PRICE = "price_usd_per_kg"
FEATURES = domain.MODEL_FEATURES


def filled_features(features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Model features of the mart with gaps filled backward, then forward."""
    return filled_both_ways(features, [KEY], columns).select(
        KEY, "price_date", *[F.col(c).cast("double").alias(c) for c in columns]
    )


def scaled_windows(
    features: DataFrame,
    fit_scope: str = "train",
    length: int = domain.SEQUENCE_LENGTH,
    min_rows_above: int = domain.TRAIN_MIN_ROWS_ABOVE,
    train_share: float = 0.8,
) -> DataFrame:
    """Training windows of scaled features with the fitted bounds on each row.

    ``fit_scope="all"`` fits the scaler on all rows, including those later used for evaluation;
    ``"train"`` uses only the rows that training windows see. Filling, fitting, scaling and windowing all
    partition by commodity, so the whole matrix needs one exchange.
    """
    if fit_scope not in ("train", "all"):
        raise ValueError(f"fit_scope must be 'train' or 'all', not {fit_scope!r}")
    whole = Window.partitionBy(KEY)
    numbered = (
        filled_features(features)
        .withColumns(
            {"_row": F.row_number().over(series_window([KEY])), "_rows": F.count(F.lit(1)).over(whole)}
        )
        .filter(F.col("_rows") > min_rows_above)
    )
    last_seen = F.col("_rows")
    if fit_scope == "train":
        last_seen = length + F.floor(F.lit(train_share) * (F.col("_rows") - length))
    seen = F.col("_row") <= last_seen
    low = {f"{f}_min": F.min(F.when(seen, F.col(f))).over(whole) for f in FEATURES}
    high = {f"{f}_max": F.max(F.when(seen, F.col(f))).over(whole) for f in FEATURES}
    bounded = numbered.withColumns({**low, **high})
    with_range = bounded.withColumns(
        {f"{f}_range": span(F.col(f"{f}_min"), F.col(f"{f}_max")) for f in FEATURES}
    ).drop(*high, "_row", "_rows")
    return training_windows(scale_columns(with_range, FEATURES), [KEY], FEATURES, length, PRICE, train_share)


# --- First-order autoregression, entirely in SQL aggregates ---


def fit_ar1(features: DataFrame) -> DataFrame:
    """Least-squares line from the previous price to the price, per commodity."""
    previous = F.lag(PRICE).over(series_window([KEY]))
    return (
        features.withColumn("_previous", previous)
        .groupBy(KEY)
        .agg(
            F.regr_slope(PRICE, "_previous").alias("slope"),
            F.regr_intercept(PRICE, "_previous").alias("intercept"),
            F.count(F.lit(1)).alias("rows"),
            F.max("price_date").alias("last_date"),
            F.max_by(PRICE, "price_date").alias("last_price"),
        )
    )


def ar1_path(steps: int) -> Column:
    """Array of the next ``steps`` predictions, each from the one before."""
    state = F.struct(F.col("last_price").alias("p"), F.array().cast("array<double>").alias("path"))

    def advance(acc: Column, _step: Column) -> Column:
        p = acc["p"] * F.col("slope") + F.col("intercept")
        return F.struct(p.alias("p"), F.concat(acc["path"], F.array(p)).alias("path"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, advance, lambda acc: acc["path"])


def with_band(predictions: DataFrame, path: str = "path", last_date: str = "last_date") -> DataFrame:
    """Forecast rows from an array of predictions: dates 30 days apart and a widening band."""
    p, step = F.col("predicted_price"), F.col("step")
    margin = p * (F.lit(domain.BAND_BASE) + F.lit(domain.BAND_STEP) * step)
    return predictions.select(
        KEY, F.col(last_date), F.posexplode(path).alias("step", "predicted_price")
    ).select(
        F.date_add(F.col(last_date), (step + 1) * domain.FORECAST_STEP_DAYS).alias("forecast_date"),
        KEY,
        "predicted_price",
        (p - margin).alias("ci_lower"),
        (p + margin).alias("ci_upper"),
    )


def ar1_forecast(
    features: DataFrame, steps: int = domain.FORECAST_STEPS, min_rows: int = domain.SEQUENCE_LENGTH
) -> DataFrame:
    fitted = fit_ar1(features).filter(F.col("rows") >= min_rows)
    return with_band(fitted.withColumn("path", ar1_path(steps)))


def ar1_holdout_error(features: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Fit on the first part of each series, predict the rest one step ahead, and report the error."""
    w = series_window([KEY])
    numbered = features.select(
        KEY,
        "price_date",
        F.col(PRICE).alias("actual"),
        F.lag(PRICE).over(w).alias("previous"),
        F.row_number().over(w).alias("_row"),
    )
    sizes = numbered.groupBy(KEY).agg(F.max("_row").alias("_rows"))
    split = numbered.join(sizes, KEY).withColumn(
        "_train", F.col("_row") <= F.floor(F.lit(train_share) * F.col("_rows"))
    )
    line = (
        split.filter("_train")
        .groupBy(KEY)
        .agg(
            F.regr_slope("actual", "previous").alias("slope"), F.regr_intercept("actual", "previous").alias("intercept")
        )
    )
    predicted = split.filter(~F.col("_train")).join(line, KEY)
    return mape(predicted.withColumn("predicted", F.col("previous") * F.col("slope") + F.col("intercept")))


def mape(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Mean absolute percentage error per commodity; rows with actual 0 do not count."""
    error = F.abs(percent_change(F.col(predicted), F.col(actual)))
    return df.groupBy(KEY).agg(F.count(F.lit(1)).alias("rows"), F.avg(error).alias("mape"))


# --- Linear model over the whole window ---


def fit_window_models(windows: DataFrame, commodities: Sequence[str] | None = None, reg_param: float = 1e-3) -> DataFrame:
    """One ridge regression per commodity on the flattened training windows, as a parameter table.

    All are fitted from one aggregation over the windows. Commodities without training windows get no model.
    """
    training = windows.filter("is_train")
    if commodities is not None:
        training = training.filter(F.col(KEY).isin(list(commodities)))
    return ridge_by_group(window_sums(training, [KEY], len(FEATURES)), KEY, reg_param)


def window_fit(windows: DataFrame, models: DataFrame, reg_param: float = 1e-3) -> DataFrame:
    """How well the parameters minimise the objective: training windows, parameters, largest gradient, mean error."""
    predicted = window_prediction(F.col("steps"), F.col("weights"), F.col("intercept"))
    return ridge_gradient(windows.filter("is_train"), models, KEY, predicted, reg_param)


def window_prediction(steps: Column, weights: Column, intercept: Column) -> Column:
    """Linear model on a flattened window, as an in-JVM dot product."""
    products = F.zip_with(F.flatten(steps), weights, lambda x, w: x * w)
    return F.aggregate(products, intercept, lambda acc, x: acc + x)


def window_path(steps: int) -> Column:
    """Recursive scaled predictions: the new price replaces the first feature of the last row, and the
    window moves on by one."""
    state = F.struct(F.col("steps").alias("window"), F.array().cast("array<double>").alias("path"))

    def advance(acc: Column, _step: Column) -> Column:
        window = acc["window"]
        p = window_prediction(window, F.col("weights"), F.col("intercept"))
        last = F.element_at(window, -1)
        new_row = F.concat(F.array(p), F.slice(last, 2, len(FEATURES) - 1))
        moved = F.concat(F.slice(window, 2, F.size(window) - 1), F.array(new_row))
        return F.struct(moved.alias("window"), F.concat(acc["path"], F.array(p)).alias("path"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, advance, lambda acc: acc["path"])


def window_forecast(
    features: DataFrame, models: DataFrame, params: DataFrame, steps: int = domain.FORECAST_STEPS
) -> DataFrame:
    """Forecast from the last window of every commodity with a fitted model and enough history."""
    length = domain.SEQUENCE_LENGTH
    filled = with_minimum_history(filled_features(features), [KEY], length)
    scaled = apply_min_max(last_rows(filled, [KEY], length), params, KEY, FEATURES)
    step = F.array(*[F.col(f) for f in FEATURES])
    bounds = [F.first(f"{PRICE}_{b}").alias(f"{PRICE}_{b}") for b in ("min", "range")]
    newest = scaled.groupBy(KEY).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("price_date", step.alias("row")))), lambda e: e["row"]
        ).alias("steps"),
        F.max("price_date").alias("last_date"),
        *bounds,
    )
    paths = newest.join(models, KEY).withColumn("path", window_path(steps))
    return with_band(paths.withColumn("path", F.transform("path", lambda p: unscaled(p, PRICE))))


def window_holdout_error(windows: DataFrame, models: DataFrame) -> DataFrame:
    """Error of the fitted models on the held-out windows, in prices."""
    held_out = windows.filter(~F.col("is_train")).join(models, KEY)
    predicted = window_prediction(F.col("steps"), F.col("weights"), F.col("intercept"))
    return mape(
        held_out.select(
            KEY, unscaled(F.col("target"), PRICE).alias("actual"), unscaled(predicted, PRICE).alias("predicted")
        )
    )


def window_scaler(windows: DataFrame) -> DataFrame:
    """The fitted bounds of a window table, one row per commodity."""
    columns = [f"{f}_{b}" for f in FEATURES for b in ("min", "range")]
    return windows.groupBy(KEY).agg(*[F.max(c).alias(c) for c in columns])


# --- Forecast view ---


def history_and_forecast(
    history: DataFrame, forecast: DataFrame, last: int = 24, currency: str = "USD"
) -> DataFrame:
    """Recent prices, and the forecast starting from the last of them so that the line has no gap."""
    scale = F.lit(float(domain.USD_TO_VND if currency == "VND" else 1))
    recent = last_rows(history, [KEY], last)
    price = F.col("price")
    anchor = last_rows(history, [KEY], 1)

    def row(part: str, day: str, value: Column, lower: Column, upper: Column) -> list[Column]:
        return [
            F.lit(part).alias("part"),
            F.col(KEY),
            F.col(day).alias("day"),
            value.alias("price"),
            lower.alias("ci_lower"),
            upper.alias("ci_upper"),
        ]

    none = F.lit(None).cast("double")
    ahead = forecast.select(
        *row(
            "forecast",
            "forecast_date",
            F.col("predicted_price") * scale,
            F.col("ci_lower") * scale,
            F.col("ci_upper") * scale,
        )
    )
    return (
        recent.select(*row("history", "price_date", price, none, none))
        .unionByName(anchor.select(*row("forecast", "price_date", price, price, price)))
        .unionByName(ahead)
    )


def forecast_insight(
    history: DataFrame, forecast: DataFrame, notable_pct: float = 5.0, currency: str = "USD"
) -> DataFrame:
    """Change from the last price to the last predicted one, its direction and whether it is notable."""
    scale = F.lit(float(domain.USD_TO_VND if currency == "VND" else 1))
    now = history.groupBy(KEY).agg(F.max_by("price", "price_date").alias("last_price"))
    end = forecast.groupBy(KEY).agg(
        (F.max_by("predicted_price", "forecast_date") * scale).alias("forecast_price")
    )
    change = percent_change(F.col("forecast_price"), F.col("last_price"))
    return (
        now.join(end, KEY)
        .withColumn("change_pct", change)
        .withColumn("trend", F.when(F.col("change_pct") > 0, domain.TREND_UP).otherwise(domain.TREND_DOWN))
        .withColumn("is_notable", F.abs("change_pct") > notable_pct)
    )
