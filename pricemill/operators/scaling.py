"""Min-max scaling per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def span(low: Column, high: Column) -> Column:
    """Width of a range, with 1 for a constant."""
    return F.when(high == low, F.lit(1.0)).otherwise(high - low)


def fit_min_max(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """One row per key with ``<feature>_min`` and ``<feature>_range``; a constant feature has range 1."""
    bounds = [c for f in features for c in (F.min(f), span(F.min(f), F.max(f)))]
    names = [f"{f}_{part}" for f in features for part in ("min", "range")]
    return df.groupBy(key).agg(*[c.alias(n) for c, n in zip(bounds, names)])


def scale_columns(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scaled features; the fitted bounds stay on the row for the way back."""
    return df.withColumns({f: (F.col(f) - F.col(f"{f}_min")) / F.col(f"{f}_range") for f in features})


def apply_min_max(df: DataFrame, params: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    return scale_columns(df.join(params, key), features)


def unscaled(value: Column, feature: str) -> Column:
    """Inverse of the scaling, from the bounds on the row."""
    return value * F.col(f"{feature}_range") + F.col(f"{feature}_min")
