"""Declarative checks. Each check gives its violating rows; a check passes when there are none."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``kind``: not_null, accepted, unique, unique_combination or relationship."""

    kind: str
    columns: tuple[str, ...]
    accepted: tuple = ()
    parent: str | None = None
    parent_column: str | None = None
    name: str = field(default="", compare=False)

    @property
    def title(self) -> str:
        return self.name or f"{self.kind}({', '.join(self.columns)})"


def not_null(column: str) -> Check:
    return Check("not_null", (column,))


def accepted(column: str, values: Sequence) -> Check:
    return Check("accepted", (column,), accepted=tuple(values))


def unique(column: str) -> Check:
    return Check("unique", (column,))


def unique_combination(*columns: str) -> Check:
    return Check("unique_combination", columns)


def relationship(column: str, parent: str, parent_column: str) -> Check:
    return Check("relationship", (column,), parent=parent, parent_column=parent_column)


def _row_condition(check: Check) -> Column | None:
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted":
        return c.isNotNull() & ~c.isin(*check.accepted)
    return None


def duplicate_keys(df: DataFrame, columns: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    rows = df.dropna(subset=list(columns)) if ignore_nulls else df
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(parents, column, "left_anti")


def violations(df: DataFrame, check: Check, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows, or duplicated keys, that break a check."""
    condition = _row_condition(check)
    if condition is not None:
        return df.filter(condition)
    if check.kind == "relationship":
        return orphans(df, check.columns[0], parents[check.parent], check.parent_column)
    return duplicate_keys(df, check.columns, ignore_nulls=check.kind == "unique")


def row_measures(checks: Sequence[Check]) -> dict[str, Column]:
    """The row-level checks and the row count as aggregates, for the job that writes the rows."""
    counts = {c.title: F.count_if(_row_condition(c)) for c in checks if _row_condition(c) is not None}
    return counts | {ROWS: F.count(F.lit(1))}


#: Name of the row count among the measures.
ROWS = "rows"


def run_key_checks(model: str, df: DataFrame, checks: Sequence[Check], parents: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """One row per check that needs a shuffle: keys that repeat, keys without a parent."""
    parts = []
    for check in checks:
        if _row_condition(check) is None:
            broken = violations(df, check, parents).agg(F.count(F.lit(1)).alias("violations"))
            parts.append(broken.select(F.lit(check.title).alias("check"), "violations"))
    return reduce(DataFrame.unionByName, parts).select(F.lit(model).alias("model"), "check", "violations") if parts else None


def run_checks(
    model: str, df: DataFrame, checks: Sequence[Check], parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row per check: model, check, violations.

    All row-level checks of a model share a single pass; only the key checks need a shuffle each.
    """
    row_checks = [c for c in checks if _row_condition(c) is not None]
    keyed = run_key_checks(model, df, checks, parents)
    if not row_checks:
        return keyed
    counts = df.agg(*[F.count_if(_row_condition(c)).alias(f"c{i}") for i, c in enumerate(row_checks)])
    rows = [
        F.struct(F.lit(model).alias("model"), F.lit(c.title).alias("check"), F.col(f"c{i}").alias("violations"))
        for i, c in enumerate(row_checks)
    ]
    found = counts.select(F.inline(F.array(*rows)))
    return found if keyed is None else found.unionByName(keyed)
