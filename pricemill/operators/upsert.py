"""Keyed merge of incoming rows into existing ones, as DataFrame transformations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_missing_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed NULLs; names are compared without case."""
    present = {c.lower() for c in df.columns}
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c.lower() not in present}
    return df.withColumns(missing) if missing else df


def keyed_upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], in_place: bool = False) -> DataFrame:
    """Existing rows whose key does not come in, plus all incoming rows.

    A NULL in a key matches nothing, so such rows stay and accumulate. Columns known to one side only
    are NULL on the other. ``in_place`` keeps rows that are partitioned by the key where they are.
    """
    arriving = incoming.select(*keys).distinct()
    if in_place:
        # A broadcast of the keys would leave the stored rows in any partitions.
        arriving = arriving.hint("merge")
    kept = existing.join(arriving, list(keys), "left_anti").select(*existing.columns)
    return kept.unionByName(incoming, allowMissingColumns=True)


def replace_day_slice(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Replace the rows of each incoming day and commodity, whatever their region or source."""
    return keyed_upsert(existing, incoming, ["price_date", "commodity"])
