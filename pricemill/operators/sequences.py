"""Training windows over the last rows of a series, ordered split and minimum history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import series_window


def with_minimum_history(df: DataFrame, keys: Sequence[str], at_least: int) -> DataFrame:
    """Series with at least this many rows."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("_rows", size).filter(F.col("_rows") >= at_least).drop("_rows")


def training_windows(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    length: int,
    target: str,
    train_share: float = 0.8,
    date_col: str = "price_date",
) -> DataFrame:
    """One row per window: the ``length`` rows before a row, and that row's target.

    A series of n rows gives n - length windows, numbered from 1; the first ``train_share`` of them,
    rounded down, are for training.
    """
    w = series_window(keys, date_col)
    before = w.rowsBetween(-length, -1)
    whole = Window.partitionBy(*keys)
    step = F.array(*[F.col(f).cast("double") for f in features])
    windows = F.count(F.lit(1)).over(whole) - length
    numbered = df.withColumns(
        {
            "window_no": F.row_number().over(w).cast("long") - length,
            "window_count": windows,
            "steps": F.collect_list(step).over(before),
            "target": F.col(target).cast("double"),
        }
    )
    return numbered.filter(F.col("window_no") >= 1).withColumn(
        "is_train", F.col("window_no") <= F.floor(F.lit(train_share) * F.col("window_count"))
    )
