import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricemill import domain, schemas
from pricemill.plans import alerts as A
from pricemill.session import run_folder
from pricemill.sources.readers import read_quotes, stream_quotes
from pricemill.sources.tables import TableStore
from pricemill.streaming import increments


def now():
    return F.lit("2024-06-01 12:00:00").cast("timestamp_ntz")
PRICES = "commodity string, price_date date, price_usd_per_kg double"
DAY = dt.date(2024, 5, 2)


def test_thresholds(make, rows):
    history = make(
        [(c, "2024-05-01", p) for c, p in [("coffee", 100.0), ("rice", 100.0), ("cotton", 100.0), ("cocoa", 0.0),
                                           ("pepper", 100.0), ("rubber", 100.0)]]
        + [("coffee", "2024-04-30", 1.0), ("coffee", "2024-05-02", 7.0)],
        PRICES,
    )
    incoming = make(
        [("coffee", DAY, 105.0), ("rice", DAY, 97.1), ("cotton", DAY, 104.5), ("cocoa", DAY, 5.0), ("pepper", DAY, 95.0),
         ("rubber", DAY, 104.9), ("cashew", DAY, 5.0)],
        PRICES,
    )
    found = A.threshold_alerts(incoming, history, DAY, now())
    assert rows(found, "alert_id", "threshold", "old_price") == [
        ("ALT_coffee_20240502_5", 5.0, 100.0),
        ("ALT_cotton_20240502_4", 4.0, 100.0),
        ("ALT_pepper_20240502_5", 5.0, 100.0),
    ]
    assert found.columns == A.ALERT_COLUMNS
    comments = dict(rows(found, "commodity", "ai_comment"))
    assert domain.DIRECTION_UP in comments["coffee"] and domain.DIRECTION_DOWN in comments["pepper"]


def test_limit_comes_before_date_filter(make, rows):
    made = [(f"a{i}", f"2024-05-{10 + i:02d}", f"2024-05-{10 + i:02d} 00:00:00") for i in range(6)]
    made[5] = ("a5", "2024-01-01", "2024-05-20 00:00:00")
    df = make(made, "alert_id string, alert_date date, created_at timestamp_ntz")
    kept = A.recent_alerts(df, dt.date(2024, 5, 14), newest=5, days=3)
    assert rows(kept, "alert_id") == [("a1",), ("a2",), ("a3",), ("a4",)]
    assert rows(A.recent_alerts(df, dt.date(2024, 5, 14), newest=2, days=3), "alert_id") == [("a4",)]


@pytest.fixture
def quotes():
    days = [dt.date(2024, 3, 1) + dt.timedelta(days=i) for i in range(6)]
    rows = [(t, 100.0 + 7 * ((i * (k + 3)) % 5), d) for k, t in enumerate(domain.TICKERS) for i, d in enumerate(days)]
    return rows + [("XX=F", 1.0, days[0]), ("KC=F", None, days[3]), ("CC=F", float("nan"), days[4]), (None, 3.0, days[0])]


def test_stream_equals_batch_and_day_by_day(spark, make, quotes, rows):
    columns = ["alert_id", "alert_date", "old_price", "new_price", "pct_change"]
    batch = TableStore(spark, run_folder(spark, "batch"))
    increments.load_quotes(batch, make(quotes, schemas.QUOTES), now(), "all")

    by_day = TableStore(spark, run_folder(spark, "days"))
    folder = run_folder(spark, "stream")
    streamed = TableStore(spark, f"{folder}/tables")
    for d in sorted({q[2] for q in quotes}):
        part = make([q for q in quotes if q[2] == d], schemas.QUOTES)
        increments.load_quotes(by_day, part, now(), d.isoformat())
    for start, end in (("2024-01-01", "2024-03-04"), ("2024-03-04", "2024-12-31")):
        part = make([q for q in quotes if start <= q[2].isoformat() < end], schemas.QUOTES)
        part.write.mode("append").json(f"{folder}/landing")
        stream = increments.quote_stream(
            stream_quotes(spark, f"{folder}/landing"), streamed, f"{folder}/state", now
        )
        stream.awaitTermination()
    expected = rows(batch.read(increments.ALERTS), *columns)
    assert len(expected) > 5
    for store in (by_day, streamed):
        assert rows(store.read(increments.ALERTS), *columns) == expected
        assert store.count(increments.PRICES) == 4 * 6
    assert read_quotes(spark, f"{folder}/landing").count() == len(quotes)
    assert sorted(r[0] for r in rows(streamed.read(increments.REJECTS), "reject_reason")) == [
        "no price", "no price", "unknown ticker", "unknown ticker",
    ]


def test_replay_changes_nothing(spark, make, quotes, rows):
    store = TableStore(spark, run_folder(spark, "replay"))
    early = make([q for q in quotes if q[2] < dt.date(2024, 3, 5)], schemas.QUOTES)
    late = make([q for q in quotes if q[2] >= dt.date(2024, 3, 5)], schemas.QUOTES)
    increments.load_quotes(store, early, now(), "1")
    increments.load_quotes(store, late, now(), "2")

    def state():
        rejects = rows(store.read(increments.REJECTS), "ticker", "reject_reason")
        return rows(store.read(increments.PRICES)), rows(store.read(increments.ALERTS)), rejects

    before = state()
    increments.load_quotes(store, late, now(), "2")
    assert state() == before
