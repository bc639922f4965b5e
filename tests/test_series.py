import datetime as dt
import random

from pyspark.sql import functions as F

from pricemill.operators import series as S

PRICES = "commodity string, price_date date, price double"


def start(n, first="2024-01-01"):
    return dt.date.fromisoformat(first) + dt.timedelta(days=n)


def test_latest_load_wins_and_ties_are_settled(make, rows):
    df = make(
        [
            ("a", "2024-01-01", 1.0, "2024-02-01 00:00:00", "x"),
            ("a", "2024-01-01", 2.0, "2024-02-02 00:00:00", "x"),
            ("b", "2024-01-01", 5.0, "2024-02-01 00:00:00", "x"),
            ("b", "2024-01-01", 5.0, "2024-02-01 00:00:00", "y"),
            ("b", "2024-01-01", 4.0, "2024-02-01 00:00:00", "z"),
            ("c", "2024-01-01", -1.0, "2024-02-01 00:00:00", "z"),
        ],
        "commodity string, price_date date, price double, ingested_at timestamp_ntz, note string",
    )
    kept = S.latest_per_key(df, ["price_date", "commodity"], ["ingested_at", "price"], F.col("price") > 0)
    assert rows(kept, "commodity", "price", "note") == [("a", 2.0, "x"), ("b", 5.0, "y")]
    assert kept.columns == df.columns


def test_weekend_fill(make, rows):
    df = make(
        [
            ("fri-mon", "2024-03-01", 1.0, "t1"),
            ("fri-mon", "2024-03-04", 2.0, "t2"),
            ("wed-mon", "2024-03-06", 3.0, "t"),
            ("wed-mon", "2024-03-11", 4.0, "t"),
            ("long gap", "2024-03-08", 5.0, "t"),
            ("long gap", "2024-03-18", 6.0, "t"),
            ("single", "2024-03-08", 7.0, "t"),
        ],
        "commodity string, price_date date, price double, ticker string",
    )
    filled = S.fill_weekends(df, ["commodity"]).filter("is_imputed")
    assert rows(filled, "commodity", "price_date", "price", "ticker") == [
        ("fri-mon", "2024-03-02", 1.0, "t1"),
        ("fri-mon", "2024-03-03", 1.0, "t1"),
        ("long gap", "2024-03-09", 5.0, "t"),
        ("long gap", "2024-03-10", 5.0, "t"),
        ("wed-mon", "2024-03-09", 3.0, "t"),
    ]
    all_rows = S.fill_weekends(df, ["commodity"])
    assert all_rows.filter("not is_imputed").count() == df.count()
    assert all_rows.groupBy("commodity", "price_date").count().filter("count > 1").isEmpty()


def test_calendar_fill_matches_brute_force(make, rows):
    random.seed(3)
    data, expected = [], []
    for name in "abc":
        days = sorted(random.sample(range(60), 15))
        values = {d: (float(d) if random.random() < 0.7 else None) for d in days}
        data += [(name, start(d), v) for d, v in values.items()]
        seen = carried = None
        for d in range(days[0], days[-1] + 1):
            if d in values:
                seen, carried = d, values[d] if values[d] is not None else carried
            expected.append((name, start(d).isoformat(), carried, d - seen, d not in values))
    filled = S.fill_calendar(make(data, PRICES), ["commodity"], carry=["price"])
    got = rows(filled, "commodity", "price_date", "price", "days_since_observed", "is_imputed")
    assert got == sorted(expected, key=repr)


def test_rolling_and_lags_match_brute_force(make):
    prices = [float(i * i % 17 + 1) for i in range(40)]
    df = make([("a", start(i), p) for i, p in enumerate(prices)], PRICES)
    out = S.with_rolling_means(df, ["commodity"], "price", {"m7": 7, "m30": 30})
    out = S.with_lags(out, ["commodity"], "price", {"lag7": 7})
    out = S.with_previous(out, ["commodity"], "price")
    for i, r in enumerate(out.orderBy("price_date").collect()):
        last7, last30 = prices[max(0, i - 6) : i + 1], prices[max(0, i - 29) : i + 1]
        assert r["m7"] == sum(last7) / len(last7)
        assert r["m30"] == sum(last30) / len(last30)
        assert r["lag7"] == (prices[i - 7] if i >= 7 else None)
        assert r["price_change_pct"] == ((prices[i] - prices[i - 1]) / prices[i - 1] * 100 if i else None)


def test_fill_both_ways(make, rows):
    df = make([("a", start(i), v) for i, v in enumerate([None, 1.0, None, 3.0, None])], PRICES)
    out = S.filled_both_ways(df, ["commodity"], ["price"])
    assert rows(out.orderBy("price_date"), "price", sort=False) == [(1.0,), (1.0,), (3.0,), (3.0,), (3.0,)]


def test_latest_row_and_latest_values_differ(make, rows):
    df = make([("a", start(0), 1.0), ("a", start(1), None)], PRICES)
    assert rows(S.latest_row(df, ["commodity"]), "price") == [(None,)]
    assert rows(S.latest_values(df, ["commodity"], ["price"]), "price") == [(1.0,)]


def test_last_rows(make, rows):
    df = make([(c, start(i), float(i)) for c in "ab" for i in range(5)], PRICES)
    assert rows(S.last_rows(df, ["commodity"], 2), "commodity", "price") == [
        ("a", 3.0), ("a", 4.0), ("b", 3.0), ("b", 4.0),
    ]


def test_as_of(make, rows):
    df = make(
        [
            ("exact", start(0), 10.0),
            ("exact", start(30), 15.0),
            ("before", start(-40), 20.0),
            ("before", start(30), 10.0),
            ("later only", start(10), 3.0),
            ("later only", start(30), 6.0),
            ("alone", start(5), 1.0),
            ("year", start(-364), 9.0),
            ("year", start(-365), 99.0),
            ("year", start(0), 5.0),
        ],
        PRICES,
    )
    out = S.with_as_of_metrics(df, ["commodity"], "price")
    assert rows(out, "commodity", "price_now", "change_pct", "high_52w", "low_52w") == sorted(
        [
            ("exact", 15.0, 50.0, 15.0, 10.0),
            ("before", 10.0, -50.0, 20.0, 10.0),
            ("later only", 6.0, 0.0, 6.0, 3.0),
            ("alone", 1.0, 0.0, 1.0, 1.0),
            ("year", 5.0, (5.0 - 9.0) / 9.0 * 100, 9.0, 5.0),
        ],
        key=repr,
    )
