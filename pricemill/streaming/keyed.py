"""Daily increment as a stream with keyed state: no micro-batch reads stored prices.

For each commodity the state holds the closes of the last days, as far back as a quote may be late, and the one
before them. That is enough to tell a repeated quote from a correction, to reject a quote that comes too late, and to
compare every accepted close with the one before its day. What a batch accepts and rejects is written as a part of
its own in append-only tables, so a batch that is replayed after a failure replaces its own rows and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .. import domain
from ..functions.columns import contract_price_per_kg
from ..operators.series import latest_per_key
from ..plans.alerts import alert_records, usable_quotes
from ..sources.tables import TableStore, stored

PRICES, ALERTS, REJECTS = "bronze.quote_prices", "bronze.quote_alerts", "bronze.quote_rejects"
REPEATED, LATE = "repeated", "late"
#: Days by which a quote may be older than the newest one of its commodity in earlier batches.
DELAY_DAYS = 10

_COUNTED = ["commodity", "ticker", "quoted_on", "close", "price"]
COUNTED = "commodity string, ticker string, quoted_on date, close double, price double, reject_reason string, quotes long"
RESULT = COUNTED + ", old_price double"
STATE = "newest date, days array<date>, prices array<double>"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def as_objects(frame: pd.DataFrame) -> pd.DataFrame:
    """Texts as Python objects: Arrow hands them over in one piece, whatever text type pandas prefers."""
    texts = [c for c in ("commodity", "ticker", "reject_reason") if c in frame]
    return frame.astype({c: object for c in texts})


def counted(quotes: DataFrame) -> DataFrame:
    """Equal quotes of a task as one row with their number, so that a commodity with most of the quotes sends each
    distinct one once per task to its state."""

    def reduce(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = [*_COUNTED, "reject_reason"]
        for part in parts:
            yield as_objects(part.groupby(by, dropna=False, sort=False).size().rename("quotes").reset_index()[[*by, "quotes"]])

    return quotes.mapInPandas(reduce, COUNTED)


def settled(known: dict[date, float], newest: date | None, quotes: dict[date, dict[float, int]], delay: int) -> tuple[dict, list, list]:
    """One batch of a commodity against what is known: (known afterwards, accepted, rejected).

    ``quotes`` counts the closes of each day. A day older than ``newest`` less the delay is late. Of several closes of
    a day the highest counts, as in the batch load; the others repeat it, and so does a close that is known. A known
    day's new close is a correction. Accepted are (day, price, price of the day before), rejected (day, price, reason,
    quotes).
    """
    accepted, rejected, known = [], [], dict(known)
    for day, closes in quotes.items():
        if newest is not None and day < newest - timedelta(days=delay):
            rejected += [(day, price, LATE, n) for price, n in closes.items()]
            continue
        winner = max(closes)
        repeated = {price: n - (price == winner and known.get(day) != winner) for price, n in closes.items()}
        rejected += [(day, price, REPEATED, n) for price, n in repeated.items() if n]
        if known.get(day) != winner:
            accepted.append(day)
            known[day] = winner
    days = sorted(known)
    before = dict(zip(days[1:], days))
    return known, [(d, known[d], known[before[d]] if d in before else None) for d in sorted(accepted)], rejected


def horizon(known: dict[date, float], delay: int) -> dict[date, float]:
    """The days that later quotes can still meet, and the last one before them."""
    if not known:
        return {}
    bound = max(known) - timedelta(days=delay)
    before = max((d for d in known if d < bound), default=bound)
    return {d: p for d, p in known.items() if d >= min(bound, before)}


class LastCloses(StatefulProcessor):
    """State of one commodity: its newest day and the closes within the horizon."""

    def __init__(self, delay: int):
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("closes", STATE)

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initial: pd.DataFrame, timers) -> None:
        known = dict(zip(initial["price_date"], initial["price"].astype(float)))
        self._keep(max(known), horizon(known, self.delay))

    def _keep(self, newest: date, known: dict[date, float]) -> None:
        days = sorted(known)
        self.state.update((newest, days, [known[d] for d in days]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        newest, known = None, {}
        if self.state.exists():
            newest, days, prices = self.state.get()
            known = dict(zip(days, prices))
        # Days and distinct closes, not quotes: a day's equal quotes are one entry with a count.
        quotes: dict[date, dict[float, int]] = {}
        source: dict[tuple, tuple] = {}
        for part in rows:
            for r in part.itertuples(index=False):
                closes = quotes.setdefault(r.quoted_on, {})
                closes[r.price] = closes.get(r.price, 0) + int(r.quotes)
                source.setdefault((r.quoted_on, r.price), (r.ticker, r.close))
        known, accepted, rejected = settled(known, newest, quotes, self.delay)
        out = [(key[0], *source[d, p][:1], d, source[d, p][1], p, None, 1, old) for d, p, old in accepted]
        out += [(key[0], *source[d, p][:1], d, source[d, p][1], p, reason, n, None) for d, p, reason, n in rejected]
        if known:
            newest = max([*known, *([newest] if newest else [])])
            self._keep(newest, horizon(known, self.delay))
        names = [c.split()[0] for c in RESULT.split(", ")]
        frame = pd.DataFrame(out, columns=names)
        frame["old_price"] = frame["old_price"].astype("float64")
        yield as_objects(frame)


def judged(quotes: DataFrame, delay_days: int = DELAY_DAYS, seed: DataFrame | None = None) -> DataFrame:
    """Stream of accepted and rejected quotes. ``seed`` (commodity, price_date, price), one row for each commodity and
    day, starts the state where prices are stored already; it is read once, when the stream starts for the first time."""
    good, bad = usable_quotes(quotes)
    priced = good.select(
        "commodity", "ticker", "quoted_on", "close", contract_price_per_kg(F.col("commodity"), F.col("close")).alias("price"),
        F.lit(None).cast("string").alias("reject_reason"),
    )
    initial = None if seed is None else last_days(seed, delay_days).groupBy("commodity")
    kept = counted(priced).groupBy("commodity").transformWithStateInPandas(
        statefulProcessor=LastCloses(delay_days), outputStructType=RESULT, outputMode="append", timeMode="none", initialState=initial
    )
    # Quotes that no state is needed for do not meet in the task of one key.
    unusable = counted(
        bad.select("commodity", "ticker", "quoted_on", "close", F.lit(None).cast("double").alias("price"), "reject_reason")
    )
    return kept.unionByName(unusable.withColumn("old_price", F.lit(None).cast("double")))


def last_days(prices: DataFrame, delay_days: int = DELAY_DAYS) -> DataFrame:
    """Of stored closes (commodity, price_date, price), those that the state of each commodity starts with."""
    newest = prices.groupBy("commodity").agg(F.max("price_date").alias("_newest"))
    dated = prices.join(newest, "commodity").withColumn("_bound", F.date_sub("_newest", delay_days))
    before = dated.filter("price_date < _bound").groupBy("commodity").agg(F.max("price_date").alias("_before"))
    return (
        dated.join(before, "commodity", "left")
        .filter(F.col("price_date") >= F.coalesce("_before", "_bound"))
        .select("commodity", "price_date", "price")
    )


def keep_batch(store: TableStore, batch: DataFrame, now: Column, load: str, number: int, **thresholds) -> None:
    """Write what a batch accepted, its alerts and what it rejected, each as the load's own part."""
    # Three tables are written from one run of the stateful job.
    rows = stored(store.spark, judged=batch)["judged"]
    accepted, rejected = rows.filter("reject_reason IS NULL"), rows.filter("reject_reason IS NOT NULL")
    prices = accepted.select(
        F.col("quoted_on").alias("price_date"),
        F.col("close").alias("price_usd"),
        F.col("price").alias("price_usd_per_kg"),
        "commodity",
        F.lit(domain.DAILY_RAW_SOURCE).alias("source"),
        "ticker",
        F.lit("unit_contract").alias("raw_unit"),
        F.lit("USD").alias("currency"),
        F.lit(domain.DAILY_REGION).alias("region"),
        F.lit(domain.DAILY_COUNTRY).alias("country"),
        now.alias("ingested_at"),
        F.lit(number).cast("long").alias("batch"),
    )
    moves = accepted.select("commodity", F.col("quoted_on").alias("price_date"), F.col("price").alias("new_price"), "old_price")
    store.replace_part(PRICES, f"load_id={load}", prices)
    store.replace_part(ALERTS, f"load_id={load}", alert_records(moves, now, **thresholds))
    store.replace_part(REJECTS, f"load_id={load}", rejected.select("ticker", "commodity", "quoted_on", "close", "reject_reason", "quotes"))


def current_prices(store: TableStore) -> DataFrame:
    """The last accepted close of each commodity and day."""
    return latest_per_key(store.read(PRICES), ["price_date", "commodity"], ["batch", "ingested_at"])


def keyed_quote_stream(
    quotes: DataFrame,
    store: TableStore,
    checkpoint: str,
    now: Callable[[], Column] = F.localtimestamp,
    delay_days: int = DELAY_DAYS,
    seed: DataFrame | None = None,
    **thresholds,
) -> StreamingQuery:
    """Load everything that has landed; the query ends when it is done, and goes on from its state when started again."""
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    conf, key = store.spark.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)

    def load(batch: DataFrame, number: int) -> None:
        keep_batch(store, batch, now(), f"{run}-{number}", number, **thresholds)

    # A query keeps the provider that is set when it starts; state of several variables needs this one.
    conf.set(key, ROCKS)
    try:
        return (
            judged(quotes, delay_days, seed)
            .writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set(key, before)
