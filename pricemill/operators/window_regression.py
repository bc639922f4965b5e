"""Ridge regressions over sliding windows, one per group, from sums that one aggregation collects.

The cross product of two cells of a window depends only on how far apart their rows lie, and on which rows the
windows cover. So it is enough to sum, for each distance, the products of a window's first row with the row at that
distance: the sum for a pair of later rows differs by a few rows at the series' ends, which the first and the last
window hold. A window of 30 rows and 5 features has 11,325 cross products; 30 rows of 25 sums replace them. Sums of
parts add up, so a group that holds most rows is reduced inside each task first, and all groups are fitted at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Variances below this are rounding; such a cell is constant and gets no weight.
CONSTANT = 1e-14


def window_sums(
    windows: DataFrame, keys: Sequence[str], features: int, number: str = "window_no", steps: str = "steps", target: str = "target"
) -> DataFrame:
    """One row per group and position in the window (from 0).

    ``lagged`` sums the products of the first row's features with those of the row at this position, ``with_target``
    the row's features times the target, ``cells`` the features. The first position also has the number of windows,
    the target's sums and the group's first and last window. Windows of a group follow each other without gaps.
    """
    first, row, y = F.get(F.col(steps), F.lit(0)), F.col("_row"), F.col(target)
    at_start = F.when(F.col("position") == 0, F.col(number))

    def total(*values):
        return F.array(*[F.sum(v) for v in values])

    cells = [F.get(row, F.lit(g)) for g in range(features)]
    return (
        windows.select(*keys, number, steps, target, F.posexplode(steps).alias("position", "_row"))
        .groupBy(*keys, "position")
        .agg(
            total(*[F.get(first, F.lit(f)) * c for f in range(features) for c in cells]).alias("lagged"),
            total(*[c * y for c in cells]).alias("with_target"),
            total(*cells).alias("cells"),
            F.count(at_start).alias("windows"),
            F.sum(F.when(at_start.isNotNull(), y)).alias("target_sum"),
            F.sum(F.when(at_start.isNotNull(), y * y)).alias("target_squares"),
            F.min_by(steps, at_start).alias("first_window"),
            F.max_by(steps, at_start).alias("last_window"),
        )
    )


def moments(lagged: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All cross products of window cells, from the lagged sums (length x features x features) and the end windows."""
    length, features = first.shape
    out = np.zeros((length, features, length, features))
    for d in range(length):
        sums = lagged[d].copy()
        for i in range(length - d):
            # From position i - 1 to i the windows lose the row before the first and gain the one after the last.
            if i:
                sums += np.outer(last[i], last[i + d]) - np.outer(first[i - 1], first[i + d - 1])
            out[i, :, i + d, :] = sums
            out[i + d, :, i, :] = sums.T
    return out.reshape(length * features, length * features)


def solved(xx: np.ndarray, xy: np.ndarray, x: np.ndarray, y: float, yy: float, n: int, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of the ridge regression with standardised features and target, by a Cholesky factor.

    The penalty is divided by the target's deviation, as MLlib's linear regression has it. A group with a feature
    that never has a value gets no numbers.
    """
    if not (np.isfinite(xx).all() and np.isfinite(xy).all()):
        return np.full(len(x), np.nan), float("nan")
    mean, y_mean = x / n, y / n
    deviation, y_deviation = np.sqrt(np.maximum(np.diag(xx) / n - mean**2, 0)), np.sqrt(max(yy / n - y_mean**2, 0))
    weights = np.zeros(len(x))
    keep = deviation**2 > CONSTANT
    if keep.any() and y_deviation**2 > CONSTANT:
        s = deviation[keep]
        r = (xx[np.ix_(keep, keep)] / n - np.outer(mean[keep], mean[keep])) / np.outer(s, s)
        c = (xy[keep] / n - mean[keep] * y_mean) / (s * y_deviation)
        lower = np.linalg.cholesky(r + penalty / y_deviation * np.eye(keep.sum()))
        weights[keep] = np.linalg.solve(lower.T, np.linalg.solve(lower, c)) * y_deviation / s
    return weights, float(y_mean - mean @ weights)


def ridge_by_group(sums: DataFrame, key: str, reg_param: float = 1e-3) -> DataFrame:
    """(key, intercept, weights) from :func:`window_sums`; a group is one small row, and each is solved in a task."""
    start = F.col("position") == 0
    columns = ("lagged", "with_target", "cells")
    groups = sums.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("position", *columns))).alias("rows"),
        *[F.max(F.when(start, F.col(c))).alias(c) for c in ("windows", "target_sum", "target_squares", "first_window", "last_window")],
    )

    def solve(parts: Iterator) -> Iterator:
        import pandas as pd

        for part in parts:
            found = []
            for g in part.itertuples(index=False):
                first, last = (np.array([list(step) for step in w], dtype=float) for w in (g.first_window, g.last_window))
                length, features = first.shape
                lagged = np.array([list(r["lagged"]) for r in g.rows], dtype=float).reshape(length, features, features)
                xy, x = (np.concatenate([np.array(list(r[c]), dtype=float) for r in g.rows]) for c in ("with_target", "cells"))
                weights, intercept = solved(moments(lagged, first, last), xy, x, g.target_sum, g.target_squares, int(g.windows), reg_param)
                found.append((getattr(g, key), intercept, weights.tolist()))
            yield pd.DataFrame(found, columns=[key, "intercept", "weights"])

    return groups.mapInPandas(solve, f"{key} string, intercept double, weights array<double>")


def ridge_gradient(windows: DataFrame, models: DataFrame, key: str, predicted, reg_param: float = 1e-3, target: str = "target") -> DataFrame:
    """Per group, the steepest component of the objective's gradient at the fitted parameters, computed from the
    windows themselves: 0 at the minimum. ``predicted`` is the model's value for a window."""
    error = predicted - F.col(target)
    pairs = F.zip_with(F.flatten("steps"), "weights", lambda x, w: F.struct(x.alias("x"), w.alias("w")))
    # The error is computed before the cells are spread, once for each window.
    told = windows.join(models, key).select(key, target, error.alias("error"), pairs.alias("_pairs"))
    cells = told.select(key, target, "error", F.posexplode("_pairs").alias("cell", "_pair")).select(
        key, target, "error", "cell", "_pair.x", "_pair.w"
    )
    slope = F.avg(F.col("x") * F.col("error")) - F.avg("x") * F.avg("error")
    # A target that never changes leaves all weights at 0.
    pull = F.coalesce(F.lit(reg_param) / F.nullif(F.stddev_pop(target), F.lit(0.0)), F.lit(0.0)) * F.var_pop("x") * F.max("w")
    by_cell = cells.groupBy(key, "cell").agg((slope + pull).alias("slope"), F.avg("error").alias("bias"), F.count("*").alias("windows"))
    return by_cell.groupBy(key).agg(
        F.max("windows").alias("windows"), F.count("*").alias("cells"), F.max(F.abs("slope")).alias("steepest"), F.max(F.abs("bias")).alias("bias")
    )
