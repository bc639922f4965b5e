"""Lookup joins: aliases to canonical names, previous closes, star keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domain
from ..functions.values import label


def alias_table(mapping: DataFrame) -> DataFrame:
    """``alias -> commodity``: raw names and canonical names in one column, without repeats."""
    raw = mapping.select(F.lower("raw_name").alias("alias"), "commodity")
    canonical = mapping.select(F.lower("commodity").alias("alias"), "commodity")
    return raw.unionByName(canonical).distinct()


def built_in_aliases() -> dict[str, str]:
    """``alias -> commodity`` of the built-in mapping."""
    return {alias.lower(): row[1] for row in domain.COMMODITY_MAPPING for alias in (row[0], row[1])}


def resolve_alias(
    df: DataFrame, name: str, mapping: DataFrame | Mapping[str, str], output: str = "commodity"
) -> DataFrame:
    """Add the canonical commodity; names unknown to the mapping keep their lower-cased text.

    A mapping of constants becomes part of the projection. A mapping table is one equi join on the alias
    column instead of an OR of two comparisons, which Spark could only run as a nested loop; it is not
    hinted, so Spark broadcasts it when its size allows, and AQE splits a hot name otherwise.
    """
    key = F.lower(F.trim(F.col(name)))
    if not isinstance(mapping, DataFrame):
        return df.withColumn(output, label(key, mapping))
    aliases = alias_table(mapping).withColumnRenamed("commodity", "_canonical")
    return (
        df.withColumn("_alias", key)
        .join(aliases, F.col("_alias") == F.col("alias"), "left")
        .withColumn(output, F.coalesce("_canonical", "_alias"))
        .drop("_alias", "alias", "_canonical")
    )


def previous_close(
    history: DataFrame, before: Column, key: str = "commodity", price: str = "price_usd_per_kg"
) -> DataFrame:
    """Per key, the latest price strictly before a day."""
    return (
        history.filter(F.col("price_date") < before)
        .groupBy(key)
        .agg(F.max(F.struct("price_date", price)).alias("_last"))
        .select(key, F.col("_last.price_date").alias("previous_date"), F.col(f"_last.{price}").alias("old_price"))
    )
