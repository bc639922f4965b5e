import datetime as dt

import pytest

from pricemill import domain
from pricemill.plans import serving, summary

PRICES = "price_date date, commodity string, price_usd_per_kg double, name_vi string, category string"


@pytest.fixture(scope="module")
def prices(make):
    rows = []
    for i in range(800):
        d = dt.date(2022, 1, 1) + dt.timedelta(days=i)
        rows += [(d, "rice", 1.0 + i / 1000, "Lua gao", None), (d, "rice", 3.0 + i / 1000, None, "grains")]
        rows.append((d, "coffee", 8.0 - i / 200, "Ca phe", "beverages"))
        rows.append((d, "tea", 2.0, None, None))
    return make(rows, PRICES)


@pytest.fixture(scope="module")
def frame(prices):
    return serving.serving_frame(prices).cache()


def test_frame(frame, prices):
    assert frame.count() == 2400
    row = frame.filter("commodity = 'rice' and price_date = '2022-01-31'").first()
    assert row["price_usd_per_kg"] == pytest.approx(2.03)
    assert row["price_change_pct"] == pytest.approx((2.03 - 2.0) / 2.0 * 100)
    assert (row["name_vi"], row["category"]) == ("Lua gao", "grains")
    dong = serving.serving_frame(prices, "VND").filter("commodity = 'rice' and price_date = '2022-01-31'").first()
    assert dong["price"] == pytest.approx(2.03 * 25_000)


def test_selection_keeps_earlier_history_in_rolling_values(frame):
    kept = serving.in_selection(frame, ["rice"], dt.date(2022, 3, 1), dt.date(2022, 3, 2))
    assert kept.count() == 2
    assert all(r["price_change_pct"] is not None for r in kept.collect())
    bounds = serving.date_bounds(serving.last_years(frame, 1, frame)).first()
    assert bounds["min_date"] == dt.date(2023, 3, 10) and bounds["max_date"] == dt.date(2024, 3, 10)
    assert serving.date_bounds(serving.last_years(frame, 5, frame)).first()["rows"] == 2400
    assert [r[0] for r in serving.members(frame).collect()] == ["coffee", "rice", "tea"]


def test_pulse_and_ranking(frame):
    pulse = serving.market_pulse(frame).first()
    assert pulse["strongest"] == "coffee" and pulse["strongest_change"] < 0 and pulse["commodities"] == 3
    ranking = [(r["commodity"], r["label"]) for r in serving.price_ranking(frame).collect()]
    assert ranking == [("tea", " tea"), ("rice", "🌾 Gạo"), ("coffee", "☕ Cà phê")]


def test_correlation_and_trend(frame):
    pair = serving.pair_correlation(frame, "rice", "coffee")
    row = pair.first()
    assert row["correlation"] == pytest.approx(-1) and row["strength"] == domain.CORRELATION_BANDS["strong"]
    assert row["slope"] == pytest.approx(-5) and row["days"] == 800
    points = serving.trend_line(pair).orderBy("point").collect()
    assert len(points) == 100
    assert points[0]["x"] == row["min_x"] and points[-1]["x"] == pytest.approx(row["max_x"])


def test_yearly(frame):
    box = serving.yearly_distribution(frame, years_back=1).filter("commodity = 'tea'").collect()
    assert sorted(r["year"] for r in box) == [2023, 2024]
    assert all((r["q1"], r["median_price"], r["mean_price"]) == (2.0, 2.0, 2.0) for r in box)
    assert {r["year"] for r in serving.yearly_means(frame, 2).collect()} == {2023, 2024}


def test_report_is_sorted_by_day(frame):
    table = serving.report_table(frame)
    assert table.columns[0] == "Tháng" and table.columns[2] == "Giá (USD/kg)"
    assert [r[0] for r in table.limit(3).collect()] == ["03/2024"] * 3


def test_period_is_counted_from_the_whole_data(frame):
    ended = frame.filter("price_date < '2023-01-01'")
    assert serving.last_years(ended, 1, frame).count() == 0 < serving.last_years(ended, 1, ended).count()


def test_summary_of_nothing_says_so(frame):
    assert summary.summary_text(frame.filter("false")).first()[0] == domain.SUMMARY_EMPTY


def test_summary_names_every_commodity(frame):
    text = summary.summary_text(frame).first()[0]
    assert all(text.count(label) for label in ["Gạo", "Cà phê", "tea: 2.0000"])


def test_summary(frame):
    lines = summary.summary_text(frame.filter("commodity <> 'tea'")).first()[0].split("\n")
    assert lines[0] == domain.SUMMARY_TITLE + "03/2024"
    assert lines[1] == "=" * 50
    assert lines[2].startswith("☕ Cà phê: 4.0050 USD/kg  (▼")
    assert lines[3].startswith("🌾 Gạo: 2.7990 USD/kg  (▲")
    assert lines[4:6] == ["", domain.SUMMARY_ALL]
    assert lines[6] == "  ☕ Cà phê: 4.0050 USD/kg"
    assert lines[10].startswith("  Năm 2022: Cà phê: 7.09 | Gạo: 2.18")
    assert lines[-3] == "Dữ liệu bắt đầu từ: 01/2022 → Cập nhật mới nhất: 03/2024"
    assert lines[-2:] == domain.SUMMARY_FOOTER


def test_serving_queries_read_one_fact(spark):
    """The fact is stored once, and built again where its folder is gone."""
    import os

    from pricemill.sources import driver_tables as D

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("supplied tables are absent")
    first = D.built_fact(spark, folder)
    assert D.built_fact(spark, folder).inputFiles() == first.inputFiles()
    key = (spark.sparkContext.applicationId, folder)
    path, schema = D._FACTS[key]
    D._FACTS[key] = f"{path}-gone", schema
    again = D.built_fact(spark, folder)
    assert again.inputFiles() != first.inputFiles() and again.count() == first.count() > 0
