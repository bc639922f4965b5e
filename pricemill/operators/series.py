"""Operators over price series: collapse to one row per day, fill gaps, lags, rolling metrics.

Every window here orders one series by day and runs *after* :func:`latest_per_key` (or another
aggregation to one row per series and day). A window partition therefore never holds more rows than
the calendar has days, however many raw rows a hot series brings: the raw rows are reduced by an
aggregation with map-side combine, which sends at most one row per key and task over the network.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import is_weekend
from ..functions.values import exact_mean_over, percent_change


def series_window(keys: Sequence[str], date_col: str = "price_date"):
    return Window.partitionBy(*keys).orderBy(date_col)


def trailing(keys: Sequence[str], rows: int, date_col: str = "price_date"):
    """Frame of the current row and the ``rows - 1`` rows before it."""
    return series_window(keys, date_col).rowsBetween(-(rows - 1), 0)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str], valid: Column | None = None
) -> DataFrame:
    """One row per key: the greatest by ``newest_first``, then by all remaining columns.

    The order is total, so equal ingest times give the same winner on every run. It is one
    aggregation, not a ranking: a key that holds a third of all rows is reduced inside each task first.
    Rows that are not ``valid`` do not compete. Testing them inside the aggregate, not in a filter, keeps
    Catalyst from copying the expressions of the tested columns into a filter below and computing them twice.
    Name the key with the most values first: it leads the sort.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_first]
    candidate = F.struct(*newest_first, *rest)
    winner = F.max(candidate if valid is None else F.when(valid, candidate)).alias("_winner")
    collapsed = df.groupBy(*keys).agg(winner)
    if valid is not None:
        collapsed = collapsed.filter(F.col("_winner").isNotNull())
    return collapsed.select(*[F.col(c) if c in keys else F.col(f"_winner.{c}").alias(c) for c in df.columns])


def fill_weekends(
    df: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str] = (),
    max_gap_days: int = 3,
    date_col: str = "price_date",
) -> DataFrame:
    """Add the weekend days that follow an observation by at most ``max_gap_days`` days.

    A missing day's last observation is simply the preceding row of its series, so the fill needs the
    date of the next row and a short ``sequence``, not a calendar join. Days after the last observation
    are not filled. Columns in ``carry`` also take their last non-null value from earlier rows.
    """
    w = series_window(keys, date_col)
    day = F.col(date_col)
    # least() skips NULLs, so the last row of a series, which has no next one, needs its own branch.
    last_filled = F.when(F.col("_next").isNull(), day).otherwise(
        F.least(F.date_sub("_next", 1), F.date_add(day, max_gap_days))
    )
    days = F.sequence(day, last_filled)
    return _carried(df, w, carry, date_col).select(
        *df.columns, F.explode(F.filter(days, lambda d: (d == day) | is_weekend(d))).alias("_day")
    ).transform(lambda filled: _onto_filled_days(filled, df.columns, date_col))


def fill_calendar(
    df: DataFrame, keys: Sequence[str], carry: Sequence[str] = (), date_col: str = "price_date"
) -> DataFrame:
    """Every day from the first to the last observation of each series, filled forward."""
    w = series_window(keys, date_col)
    day = F.col(date_col)
    days = F.sequence(day, F.coalesce(F.date_sub("_next", 1), day))
    return _carried(df, w, carry, date_col).select(*df.columns, F.explode(days).alias("_day")).transform(
        lambda filled: _onto_filled_days(filled, df.columns, date_col)
    )


def _carried(df: DataFrame, w, carry: Sequence[str], date_col: str) -> DataFrame:
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    last_seen = {c: F.last(c, ignorenulls=True).over(so_far) for c in carry}
    return df.withColumns({**last_seen, "_next": F.lead(date_col).over(w)})


def _onto_filled_days(filled: DataFrame, columns: Sequence[str], date_col: str) -> DataFrame:
    observed = F.col(date_col)
    return filled.select(
        *[F.col("_day").alias(c) if c == date_col else F.col(c) for c in columns],
        observed.alias("last_observed_date"),
        F.datediff("_day", observed).alias("days_since_observed"),
        (F.col("_day") != observed).alias("is_imputed"),
    )


def series_bounds(df: DataFrame, keys: Sequence[str], date_col: str = "price_date") -> DataFrame:
    """First and last day of each series."""
    return df.groupBy(*keys).agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))


def with_lags(
    df: DataFrame, keys: Sequence[str], value: str, lags: Mapping[str, int], date_col: str = "price_date"
) -> DataFrame:
    w = series_window(keys, date_col)
    return df.withColumns({name: F.lag(value, n).over(w) for name, n in lags.items()})


def with_rolling_means(
    df: DataFrame, keys: Sequence[str], value: str, means: Mapping[str, int], date_col: str = "price_date"
) -> DataFrame:
    """Means over the last n observations, partial at the start of a series."""
    return df.withColumns(
        {name: exact_mean_over(F.col(value), trailing(keys, n, date_col)) for name, n in means.items()}
    )


def with_previous(df: DataFrame, keys: Sequence[str], value: str, date_col: str = "price_date") -> DataFrame:
    """Previous observation and percent change against it."""
    previous = f"previous_{value}"
    return with_lags(df, keys, value, {previous: 1}, date_col).withColumn(
        "price_change_pct", percent_change(F.col(value), F.col(previous))
    )


def filled_both_ways(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], date_col: str = "price_date"
) -> DataFrame:
    """Replace NULLs by the next value of the series, then by the previous one."""
    w = series_window(keys, date_col)
    ahead = w.rowsBetween(0, Window.unboundedFollowing)
    behind = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {
            c: F.coalesce(F.first(c, ignorenulls=True).over(ahead), F.last(c, ignorenulls=True).over(behind))
            for c in columns
        }
    )


def last_rows(df: DataFrame, keys: Sequence[str], n: int, date_col: str = "price_date") -> DataFrame:
    """The last ``n`` rows of each series; Spark cuts each task's input to ``n`` per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.desc(date_col))
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def latest_row(df: DataFrame, keys: Sequence[str], date_col: str = "price_date") -> DataFrame:
    """The row with the greatest date per key, with its NULLs."""
    return latest_per_key(df, keys, [date_col])


def latest_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str], date_col: str = "price_date") -> DataFrame:
    """Per key and column, the latest value that is not NULL; rows may differ between columns.

    The column itself breaks ties of the date, so the result does not depend on row order.
    """

    def latest(c: str) -> Column:
        return F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(date_col), F.col(c)))).getField(c)

    return df.groupBy(*keys).agg(*[latest(c).alias(c) for c in columns])


def with_as_of_metrics(
    df: DataFrame,
    keys: Sequence[str],
    value: str = "price",
    lookback_days: int = 30,
    range_days: int = 364,
    date_col: str = "price_date",
) -> DataFrame:
    """Per series: latest value, change against the value ``lookback_days`` before it, and the range.

    The earlier value is the latest one at or before the cutoff; without one the change is 0. The
    partition maximum and the aggregation share one exchange.
    """
    day = F.col(date_col)
    latest_day = F.max(date_col).over(Window.partitionBy(*keys))
    in_range = F.when(day >= F.date_sub("_latest", range_days), F.col(value))
    past_day = F.when(day <= F.date_sub("_latest", lookback_days), day)
    return (
        df.withColumn("_latest", latest_day)
        .groupBy(*keys)
        .agg(
            F.max("_latest").alias("latest_date"),
            F.max_by(value, day).alias("price_now"),
            F.max_by(value, past_day).alias("price_past"),
            F.max(in_range).alias("high_52w"),
            F.min(in_range).alias("low_52w"),
        )
        .withColumn("change_pct", F.coalesce(percent_change(F.col("price_now"), F.col("price_past")), F.lit(0.0)))
    )
