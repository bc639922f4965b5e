"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored

#: Ranks that the sketch may be off, as a part of a group's rows.
ACCURACY = 10_000


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """One row per group with ``quantiles``: the values at the given shares, interpolated between neighbours.

    A mergeable sketch gives each wanted rank two values that it lies between. A second pass counts the smaller values
    and, value by value, those in between; only these, less than a thousandth of a group or at most ``accuracy`` values,
    meet in one place. NULLs are left aside; a group without values gives NULL, and one with a NULL key no quantiles.
    """
    spark = df.sparkSession
    rows = df.select(*keys, F.col(value).alias("_value"))
    margin = 4 / accuracy
    edges = [edge for s in shares for edge in (max(s - margin, 0.0), min(s + margin, 1.0))]
    sketch = F.percentile_approx("_value", edges, accuracy)
    # In a small group the margin is less than a rank, so all of it lies between.
    small = F.col("_n") <= accuracy
    bounds = rows.groupBy(*keys).agg(sketch.alias("_edges"), F.min("_value").alias("_min"), F.max("_value").alias("_max"), F.count("_value").alias("_n"))
    low = [F.when(small | F.lit(s <= margin), F.col("_min")).otherwise(F.get("_edges", F.lit(2 * i))) for i, s in enumerate(shares)]
    high = [F.when(small | F.lit(s >= 1 - margin), F.col("_max")).otherwise(F.get("_edges", F.lit(2 * i + 1))) for i, s in enumerate(shares)]
    wanted = [
        F.struct(F.lit(i).alias("i"), F.lit(s).alias("share"), a.alias("low"), b.alias("high")) for i, (s, a, b) in enumerate(zip(shares, low, high))
    ]
    brackets = stored(spark, brackets=bounds.select(*keys, "_n", F.array(*wanted).alias("_wanted")))["brackets"]
    joined = rows.filter("_value IS NOT NULL").join(brackets, list(keys)).select(*keys, "_value", "_n", F.explode("_wanted").alias("_w"))
    below = F.col("_value") < F.col("_w.low")
    inside = joined.filter(F.col("_value") <= F.col("_w.high"))
    counted = inside.groupBy(*keys, "_w", "_n", F.when(~below, F.col("_value")).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    upto = Window.partitionBy(*keys, "_w").orderBy(F.col("_value").asc_nulls_first())
    ranked = counted.withColumn("_upto", F.sum("_rows").over(upto))
    position = (F.col("_n") - 1) * F.col("_w.share")
    left, right = F.floor(position), F.ceil(position)

    def at(rank):
        return F.min(F.when(F.col("_value").isNotNull() & (F.col("_upto") > rank), F.col("_value")))

    ends = ranked.groupBy(*keys, "_w", "_n").agg(at(left).alias("_a"), at(right).alias("_b"))
    between = F.when(left == right, F.col("_a")).otherwise((right - position) * F.col("_a") + (position - left) * F.col("_b"))
    found = ends.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_w.i").alias("i"), between.alias("v")))), lambda x: x["v"]).alias("quantiles"))
    return brackets.select(*keys).join(found, list(keys), "left")
