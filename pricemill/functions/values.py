"""Literal tables and exact arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Declared type of stored prices.
PRICE = "decimal(18,6)"
#: Type in which means of doubles are summed: nine decimals, which a double of price size still holds.
FINE = "decimal(28,9)"


def literal_map(values: Mapping) -> Column:
    """Map column built from driver-side constants; no join, no task data."""
    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def lookup(key: Column, values: Mapping) -> Column:
    """``values[key]`` or NULL."""
    return F.try_element_at(literal_map(values), key)


def label(code: Column, names: Mapping[str, str], fallback: Column | None = None) -> Column:
    """Display name of a code; the code itself (or ``fallback``) when it has none."""
    return F.coalesce(lookup(code, names), code if fallback is None else fallback)


def constant_frame(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Small frame from constants. It is a local relation of known size: no Python worker, no size guess."""
    return spark.createDataFrame(pa.table([pa.array(column) for column in zip(*rows)], names=list(names)))


def exact_mean(value: Column, dtype: str = PRICE) -> Column:
    """Mean as exact decimal sum over count.

    The sum of decimals does not depend on the order in which partial aggregates are merged, so the
    result is the same on every run and every cluster size; a sum of doubles is not.
    """
    exact = value.cast(dtype)
    return F.sum(exact).cast("double") / F.nullif(F.count(exact), F.lit(0))


def exact_mean_over(value: Column, frame, dtype: str = PRICE) -> Column:
    """Windowed variant of :func:`exact_mean`."""
    exact = value.cast(dtype)
    return F.sum(exact).over(frame).cast("double") / F.nullif(F.count(exact).over(frame), F.lit(0))


def percent_change(new: Column, old: Column) -> Column:
    """``(new - old) / old * 100`` in double; NULL when the old value is NULL or zero."""
    new, old = new.cast("double"), old.cast("double")
    return F.when(old != 0, (new - old) / F.nullif(old, F.lit(0.0)) * 100)


