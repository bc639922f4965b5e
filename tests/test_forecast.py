import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricemill import domain
from pricemill.operators.scaling import apply_min_max, fit_min_max, unscaled
from pricemill.operators.window_regression import moments, window_sums
from pricemill.operators.sequences import training_windows, with_minimum_history
from pricemill.plans import forecast as FC

FEATURES = "commodity string, price_date date, " + ", ".join(f"{f} double" for f in domain.MODEL_FEATURES)
START = dt.date(2024, 1, 1)


def day(i):
    return START + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(5)
    price = 100 + np.cumsum(rng.normal(0, 1, 90))
    table = np.full((90, 5), np.nan)
    table[:, 0] = price
    table[1:, 1] = price[:-1]
    table[7:, 2] = price[:-7]
    for i in range(90):
        last = price[max(0, i - 29) : i + 1]
        table[i, 3] = last.mean()
        table[i, 4] = last.std(ddof=1) if i else np.nan
    return table


@pytest.fixture(scope="module")
def features(make, series):
    rows = [("rice", day(i), *[None if np.isnan(x) else float(x) for x in r]) for i, r in enumerate(series)]
    return make(rows, FEATURES)


def filled(table):
    out = table.copy()
    for c in range(out.shape[1]):
        first = np.flatnonzero(~np.isnan(out[:, c]))[0]
        out[:first, c] = out[first, c]
    return out


def ridge(x, y, reg):
    """Independent solution of the model MLlib fits: standardised features, penalty on them, free intercept."""
    sx, sy = x.std(axis=0), y.std()
    keep = sx > 0
    z, t = (x[:, keep] - x[:, keep].mean(0)) / sx[keep], (y - y.mean()) / sy
    n = len(y)
    w = np.linalg.solve(z.T @ z / n + reg / sy * np.eye(keep.sum()), z.T @ t / n)
    weights = np.zeros(x.shape[1])
    weights[keep] = w * sy / sx[keep]
    return weights, y.mean() - weights @ x.mean(0)


def test_scaling_with_constant_feature(make, rows):
    df = make([("a", 1.0, 7.0), ("a", 3.0, 7.0), ("b", 5.0, 5.0)], "k string, x double, c double")
    scaled = apply_min_max(df, fit_min_max(df, "k", ["x", "c"]), "k", ["x", "c"])
    assert rows(scaled, "k", "x", "c") == [("a", 0.0, 0.0), ("a", 1.0, 0.0), ("b", 0.0, 0.0)]
    back = scaled.select(unscaled(F.col("x"), "x"), unscaled(F.col("c"), "c"))
    assert rows(back) == [(1.0, 7.0), (3.0, 7.0), (5.0, 5.0)]


@pytest.mark.parametrize("n, windows, kept", [(30, 0, 0), (31, 1, 0), (40, 10, 0), (41, 11, 41)])
def test_window_counts(make, n, windows, kept):
    df = make([("a", day(i), float(i)) for i in range(n)], "commodity string, price_date date, p double")
    made = training_windows(df, ["commodity"], ["p"], 30, "p").orderBy("window_no").collect()
    assert len(made) == windows
    for r in made:
        k = r["window_no"]
        assert [s[0] for s in r["steps"]] == [float(x) for x in range(k - 1, k + 29)]
        assert r["target"] == float(k + 29)
        assert r["is_train"] == (k <= int(0.8 * windows))
    assert with_minimum_history(df, ["commodity"], domain.TRAIN_MIN_ROWS_ABOVE + 1).count() == kept


def test_fit_scope(features, series):
    full = filled(series)
    last_train_row = 30 + int(0.8 * 60)
    for scope, used in (("all", full), ("train", full[:last_train_row])):
        bounds = FC.window_scaler(FC.scaled_windows(features, scope)).first()
        for i, f in enumerate(domain.MODEL_FEATURES):
            assert bounds[f"{f}_min"] == pytest.approx(used[:, i].min())
            assert bounds[f"{f}_range"] == pytest.approx(np.ptp(used[:, i]))
    with pytest.raises(ValueError):
        FC.scaled_windows(features, "some")


def test_ar1_follows_a_line(make, rows):
    prices = [100.0]
    for _ in range(39):
        prices.append(prices[-1] * 0.9 + 5)
    df = make(
        [("a", day(i), p) for i, p in enumerate(prices)] + [("short", day(i), 1.0 + i) for i in range(29)],
        "commodity string, price_date date, price_usd_per_kg double",
    )
    out = FC.ar1_forecast(df).orderBy("forecast_date").collect()
    assert [r["forecast_date"] for r in out] == [day(39 + 30 * (i + 1)) for i in range(6)]
    expected = prices[-1]
    for i, r in enumerate(out):
        expected = expected * 0.9 + 5
        assert r["commodity"] == "a"
        assert r["predicted_price"] == pytest.approx(expected)
        assert r["ci_upper"] - r["predicted_price"] == pytest.approx(expected * (0.05 + 0.01 * i))
        assert r["ci_lower"] < r["predicted_price"] < r["ci_upper"]
    error = {r["commodity"]: r for r in FC.ar1_holdout_error(df).collect()}
    assert error["a"]["rows"] == 8 and error["a"]["mape"] == pytest.approx(0, abs=1e-6)


def test_window_models_match_brute_force(spark, features, series):
    windows = FC.scaled_windows(features).cache()
    models = FC.fit_window_models(windows, ["rice", "coffee"])
    assert models.count() == 1
    table = filled(series)
    low, span = table[:78].min(0), np.ptp(table[:78], axis=0)
    scaled = (table - low) / span
    x = np.array([scaled[i : i + 30].ravel() for i in range(60)])
    y = scaled[30:, 0]
    weights, intercept = ridge(x[:48], y[:48], 1e-3)
    fitted = models.first()
    assert np.array(fitted["weights"]) == pytest.approx(weights, abs=1e-6)
    assert fitted["intercept"] == pytest.approx(intercept, abs=1e-6)

    window, path = scaled[-30:].copy(), []
    for _ in range(6):
        p = float(window.ravel() @ weights + intercept)
        path.append(p * span[0] + low[0])
        row = window[-1].copy()
        row[0] = p
        window = np.vstack([window[1:], row])
    out = FC.window_forecast(features, models, FC.window_scaler(windows)).orderBy("forecast_date").collect()
    assert [r["predicted_price"] for r in out] == pytest.approx(path, rel=1e-6)

    predicted, actual = x[48:] @ weights + intercept, y[48:]
    predicted, actual = predicted * span[0] + low[0], actual * span[0] + low[0]
    error = FC.window_holdout_error(windows, models).first()
    assert error["rows"] == 12
    assert error["mape"] == pytest.approx(np.abs((actual - predicted) / actual).mean() * 100)


def test_models_of_many_commodities_match_mllib(spark, make):
    """One aggregation fits all; each gets what a regression of its own would give it."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(8)
    rows = []
    for c, n in (("rice", 95), ("coffee", 41), ("cocoa", 160), ("short", 40), ("flat", 60)):
        price = 50 + np.cumsum(rng.normal(0, 1, n)) if c != "flat" else np.full(n, 3.0)
        rows += [(c, day(i), float(price[i]), float(price[max(i - 1, 0)]), float(price[max(i - 7, 0)]), float(rng.normal()), 1.0) for i in range(n)]
    windows = FC.scaled_windows(make(rows, FEATURES))
    models = {r["commodity"]: r for r in FC.fit_window_models(windows).collect()}
    assert set(models) == {"rice", "coffee", "cocoa", "flat"}
    assert models["flat"]["weights"] == [0.0] * 150 and models["flat"]["intercept"] == 0.0
    for c in ("rice", "coffee", "cocoa"):
        training = windows.filter((F.col("commodity") == c) & F.col("is_train")).select(
            array_to_vector(F.flatten("steps")).alias("features"), F.col("target").alias("label")
        )
        fitted = LinearRegression(regParam=1e-3, elasticNetParam=0.0, solver="normal").fit(training)
        assert np.array(models[c]["weights"]) == pytest.approx(fitted.coefficients.toArray(), abs=1e-6)
        assert models[c]["intercept"] == pytest.approx(fitted.intercept, abs=1e-6)
    found = {r["commodity"]: r for r in FC.window_fit(windows, FC.fit_window_models(windows)).collect()}
    assert found["rice"]["windows"] == 52 and found["rice"]["cells"] == 150
    assert all(found[c]["steepest"] < 1e-9 and found[c]["bias"] < 1e-9 for c in ("rice", "coffee", "cocoa"))
    plan = FC.fit_window_models(windows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(commodity") <= 3 and "partial_sum" in plan


def test_window_sums_are_all_cross_products(spark, make):
    rng = np.random.default_rng(9)
    table = rng.normal(size=(23, 2))
    df = make([("a", day(i), float(x), float(y)) for i, (x, y) in enumerate(table)], "commodity string, price_date date, p double, q double")
    windows = training_windows(df, ["commodity"], ["p", "q"], 6, "p")
    sums = sorted(window_sums(windows, ["commodity"], 2).collect(), key=lambda r: r["position"])
    x = np.array([table[i : i + 6].ravel() for i in range(17)])
    lagged = np.array([r["lagged"] for r in sums]).reshape(6, 2, 2)
    first, last = (np.array(sums[0][c]) for c in ("first_window", "last_window"))
    assert moments(lagged, first, last) == pytest.approx(x.T @ x)
    assert np.concatenate([r["with_target"] for r in sums]) == pytest.approx(x.T @ table[6:, 0])
    assert sums[0]["windows"] == 17 and sums[0]["target_squares"] == pytest.approx((table[6:, 0] ** 2).sum())


def test_stitch_and_insight(make, rows):
    history = make(
        [("a", day(i), float(i + 1)) for i in range(30)], "commodity string, price_date date, price double"
    )
    forecast = make(
        [(day(60), "a", 31.0, 30.0, 32.0), (day(90), "a", 33.0, 30.0, 36.0)],
        "forecast_date date, commodity string, predicted_price double, ci_lower double, ci_upper double",
    )
    line = FC.history_and_forecast(history, forecast)
    assert line.filter("part = 'history'").count() == 24
    assert rows(line.filter("part = 'forecast'"), "day", "price", "ci_lower", "ci_upper") == [
        (day(29).isoformat(), 30.0, 30.0, 30.0),
        (day(60).isoformat(), 31.0, 30.0, 32.0),
        (day(90).isoformat(), 33.0, 30.0, 36.0),
    ]
    insight = FC.forecast_insight(history, forecast).first()
    assert insight["change_pct"] == pytest.approx(10) and insight["is_notable"]
    assert insight["trend"] == domain.TREND_UP
