"""Daily increment as a stream over a landing folder.

Each micro-batch runs the same job as the batch load. It compares against prices strictly before each
quote's own day and stores prices and alerts by key, so a batch that is replayed after a lost driver or
executor leaves the same tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans.alerts import Increment, daily_increment
from ..session import run_folder
from ..sources.tables import TableStore, stored

PRICES, ALERTS, REJECTS = "bronze.yf_prices_raw", "bronze.price_alerts", "bronze.quote_rejects"


def apply_increment(store: TableStore, increment: Increment, prices: str = PRICES, alerts: str = ALERTS) -> None:
    """Store an increment: alerts first, since they are read against the prices before the load."""
    staged = f"{run_folder(store.spark, 'increment')}/alerts"
    increment.alerts.write.parquet(staged)
    found = store.spark.read.parquet(staged)
    store.upsert(prices, increment.prices, ["price_date", "commodity"])
    store.upsert(alerts, found, ["alert_id", "alert_date"], date_col="alert_date")


def load_quotes(store: TableStore, quotes: DataFrame, now: Column, load_id: str, **thresholds) -> None:
    """Batch load of quotes into the store; ``load_id`` names the load, so that it can be repeated."""
    # Prices, alerts and rejects each read the load; it is parsed once.
    quotes = stored(store.spark, quotes=quotes)["quotes"]
    history = store.read(PRICES, schemas.BRONZE_DAILY)
    increment = daily_increment(quotes, history, now, **thresholds)
    apply_increment(store, increment)
    store.replace_part(REJECTS, f"load_id={load_id}", increment.rejects)


def quote_stream(
    quotes: DataFrame,
    store: TableStore,
    checkpoint: str,
    now: Callable[[], Column] = F.localtimestamp,
    **thresholds,
) -> StreamingQuery:
    """Start the load of everything that has landed; the query ends when it is done.

    Batches count from 0 in each checkpoint, so loads are named by checkpoint and batch: a replay replaces its own
    rejects, and another stream's stay.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        load_quotes(store, batch, now(), f"{run}-{batch_id}", **thresholds)

    return (
        quotes.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
