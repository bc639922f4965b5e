import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricemill import schemas
from pricemill.plans import alerts as A
from pricemill.session import run_folder
from pricemill.sources.readers import stream_quotes
from pricemill.sources.tables import TableStore
from pricemill.streaming import keyed

DAY = dt.date(2024, 3, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def now():
    return F.lit("2024-06-01 12:00:00").cast("timestamp_ntz")


def test_one_batch_against_what_is_known():
    known, accepted, rejected = keyed.settled({}, None, {day(0): {5.0: 1}, day(2): {6.0: 3, 7.0: 1}}, 3)
    assert known == {day(0): 5.0, day(2): 7.0}
    assert accepted == [(day(0), 5.0, None), (day(2), 7.0, 5.0)]
    assert rejected == [(day(2), 6.0, "repeated", 3)]
    # A known close repeats, another one corrects it, a day in between is new, and an old one is late.
    quotes = {day(2): {7.0: 2}, day(0): {5.5: 1}, day(1): {6.0: 1}, day(-2): {4.0: 2}}
    known, accepted, rejected = keyed.settled(known, day(2), quotes, 3)
    assert accepted == [(day(0), 5.5, None), (day(1), 6.0, 5.5)]
    assert rejected == [(day(2), 7.0, "repeated", 2), (day(-2), 4.0, "late", 2)]
    assert known == {day(0): 5.5, day(1): 6.0, day(2): 7.0}


def test_state_is_bounded():
    known = {day(n): float(n) for n in range(0, 100, 2)}
    kept = keyed.horizon(known, 5)
    assert sorted(kept) == [day(92), day(94), day(96), day(98)]  # the bound is day 93, and one before it
    assert keyed.horizon({day(0): 1.0}, 5) == {day(0): 1.0} and keyed.horizon({}, 5) == {}
    assert sorted(keyed.horizon({day(0): 1.0, day(50): 2.0}, 5)) == [day(0), day(50)]


@pytest.fixture
def place(spark):
    folder = run_folder(spark, "keyed")
    return TableStore(spark, f"{folder}/tables"), folder


def land(make, folder, quotes):
    make(quotes, schemas.QUOTES).repartition(3).write.mode("append").json(f"{folder}/landing")


def run(spark, store, folder, **more):
    stream = keyed.keyed_quote_stream(stream_quotes(spark, f"{folder}/landing"), store, f"{folder}/state", now, **more)
    stream.awaitTermination()
    return stream


def quote(ticker, n, close):
    return (ticker, close, day(n))


def test_repeated_and_late_quotes_have_their_rows(spark, make, place, rows):
    store, folder = place
    land(make, folder, [quote("KC=F", n, 100.0 + n) for n in range(30)] + [quote("KC=F", 3, 103.0), quote("XX=F", 1, 1.0), quote("CC=F", 2, None)])
    run(spark, store, folder)
    # Landed twice, corrected, out of order, too late; and a first quote of another commodity.
    land(make, folder, [quote("KC=F", 29, 129.0), quote("KC=F", 28, 200.0), quote("KC=F", 31, 131.0), quote("KC=F", 30, 130.0), quote("KC=F", 2, 9.0), quote("ZR=F", 0, 5.0)])
    run(spark, store, folder)
    assert rows(store.read(keyed.REJECTS), "ticker", "quoted_on", "close", "reject_reason", "quotes") == sorted(
        [
            ("CC=F", day(2).isoformat(), None, "no price", 1),
            ("KC=F", day(2).isoformat(), 9.0, "late", 1),
            ("KC=F", day(29).isoformat(), 129.0, "repeated", 1),
            ("KC=F", day(3).isoformat(), 103.0, "repeated", 1),
            ("XX=F", day(1).isoformat(), 1.0, "unknown ticker", 1),
        ],
        key=repr,
    )
    prices = {(r.commodity, r.price_date): r.price_usd for r in keyed.current_prices(store).collect()}
    assert len(prices) == 33 and prices["coffee", day(28)] == 200.0 and prices["coffee", day(2)] == 102.0
    alerts = {(r.alert_date, r.old_price, r.new_price) for r in store.read(keyed.ALERTS).collect()}
    kg = lambda x: pytest.approx(x / 100 / 0.45359237)
    assert len(alerts) == 1 and [(d, o, n) for d, o, n in alerts] == [(day(28), kg(127.0), kg(200.0))]


def test_equal_to_the_batch_load(spark, make, place, rows):
    """Days in order, spread over starts of the stream: the same alerts as one batch over all days."""
    store, folder = place
    quotes = [(t, 100.0 + 7 * ((i * (k + 3)) % 5), day(i)) for k, t in enumerate(("KC=F", "ZR=F", "CC=F", "CT=F")) for i in range(12)]
    for start, end in ((0, 4), (4, 5), (5, 12)):
        land(make, folder, [q for q in quotes if day(start) <= q[2] < day(end)])
        run(spark, store, folder)
    good, _ = A.usable_quotes(make(quotes, schemas.QUOTES))
    prices = A.quotes_to_prices(good, now())
    want = A.multi_day_alerts(prices, prices.limit(0), now())
    columns = ["alert_id", "alert_date", "old_price", "new_price", "pct_change"]
    assert rows(store.read(keyed.ALERTS), *columns) == rows(want, *columns)
    assert keyed.current_prices(store).count() == 48


def test_state_starts_from_stored_prices(spark, make, place):
    store, folder = place
    seed = make([("coffee", day(n), 1.0 + n) for n in range(40)], "commodity string, price_date date, price double")
    assert keyed.last_days(seed, 10).count() == 12
    land(make, folder, [quote("KC=F", 40, 50 * 100 * 0.45359237), quote("KC=F", 5, 3.0)])
    run(spark, store, folder, seed=seed)
    alert = store.read(keyed.ALERTS).first()
    assert alert.old_price == 40.0 and alert.new_price == pytest.approx(50.0)
    assert [r.reject_reason for r in store.read(keyed.REJECTS).collect()] == ["late"]


def test_a_batch_is_kept_as_a_whole_and_reads_no_prices(spark, make, place, rows):
    store, folder = place
    land(make, folder, [quote("KC=F", n, 100.0 + 20 * n) for n in range(5)])
    stream = run(spark, store, folder)
    before = [rows(store.read(t)) for t in (keyed.PRICES, keyed.ALERTS)]
    # The same batch once more, as after a failure between its tables.
    batch = make([("coffee", "KC=F", day(n), 100.0 + 20 * n, (100.0 + 20 * n) / 100 / 0.45359237, None, 1, (100.0 + 20 * (n - 1)) / 100 / 0.45359237 if n else None) for n in range(5)], keyed.RESULT)
    part = store.read(keyed.PRICES).first().load_id
    keyed.keep_batch(store, batch, now(), part, 0)
    assert [len(rows(store.read(t))) for t in (keyed.PRICES, keyed.ALERTS)] == [len(b) for b in before]
    land(make, folder, [quote("KC=F", 5, 100.0)])
    stream = run(spark, store, folder)
    plan = stream._jsq.explainInternal(True)
    assert "TransformWithState" in plan and "/tables/" not in plan
