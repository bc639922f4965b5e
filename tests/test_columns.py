import pytest
from pyspark.sql import functions as F

from pricemill import domain
from pricemill.functions import calendar as K
from pricemill.functions import columns as C
from pricemill.functions.values import label, percent_change
from pricemill.operators.lookups import built_in_aliases, resolve_alias
from pricemill.sources.readers import read_mapping


def test_periods(make, rows):
    cases = [
        ("2024M03", None, None, "2024-03-01"),
        ("2024-03-05", None, None, "2024-03-05"),
        ("2024/03/05", None, None, "2024-03-05"),
        ("2024-03-05 10:11:12", None, None, "2024-03-05"),
        ("2024", None, None, None),
        ("nan", None, None, None),
        ("2024M13", None, None, None),
        ("20x4M01", None, None, None),
        ("2024M5 ", None, None, "2024-05-01"),
        ("2024M13", 2024, 1, None),
        ("2024-02-30", None, None, None),
        (None, 2023, 7, "2023-07-01"),
        (None, 2023, None, "2023-01-01"),
        (None, 2023, 13, "2023-01-01"),
        (None, None, 5, None),
        ("nan", 2022, 2, "2022-02-01"),
    ]
    df = make([(i, *c[:3]) for i, c in enumerate(cases)], "i int, t string, y int, m int")
    parsed = df.orderBy("i").select(C.parse_period(F.col("t"), F.col("y"), F.col("m")).alias("d"))
    assert [r[0] for r in rows(parsed, sort=False)] == [c[3] for c in cases]


def test_monthly_units(make):
    cases = [
        ("rice", "kg", 1.0),
        ("cocoa", "USD/ton", 1.0),
        ("cocoa", "$/mt", 1.0),
        ("cocoa", "$/t", 1.0),
        ("cocoa", "T", 1.0),
        ("cocoa", "MT", 1.0),
        ("cocoa", "US cents/lb", 1000 / 0.45359237),
        ("cocoa", None, 1000.0),
        ("cocoa", "kg", 1000.0),
        (None, "kg", 1000.0),
    ]
    df = make([(i, c, u, 1000.0) for i, (c, u, _) in enumerate(cases)], "i int, c string, u string, p double")
    got = df.orderBy("i").select(C.monthly_price_per_kg(F.col("c"), F.col("u"), F.col("p"))).collect()
    assert [r[0] for r in got] == [c[2] for c in cases]


def test_daily_units(make):
    lb, cwt = domain.LB_TO_KG, domain.CWT_TO_KG
    cases = [
        (3.5, "cents/lb", "KC=F", 3.5),
        (None, "Cents/LB", None, 100.0 / 100 / lb),
        (None, "?", "CT=F", 100.0 / 100 / lb),
        (None, "cents/cwt", None, 100.0 / 100 / cwt),
        (None, None, "ZR=F", 100.0 / 100 / cwt),
        (None, "USD/mt", None, 0.1),
        (None, "usd/metric_ton", None, 0.1),
        (None, "", "CC=F", 0.1),
        (None, "bushel", "XX=F", None),
    ]
    df = make([(i, p, u, t, 100.0) for i, (p, u, t, _) in enumerate(cases)], "i int, p double, u string, t string, c double")
    got = df.orderBy("i").select(C.daily_price_per_kg(F.col("p"), F.col("u"), F.col("t"), F.col("c"))).collect()
    assert [r[0] for r in got] == [c[3] for c in cases]


def test_contract_rice_differs_from_daily_rule(make):
    df = make([("rice", 15.0), ("coffee", 200.0), ("cotton", 80.0), ("cocoa", 9000.0), ("tea", 1.0)], "c string, p double")
    got = [r[0] for r in df.select(C.contract_price_per_kg(F.col("c"), F.col("p"))).collect()]
    assert got == [15.0 / 45.359237 * 2.2, 200.0 / 100 / 0.45359237, 80.0 / 100 / 0.45359237, 9.0, None]


def test_blanks(make, rows):
    df = make([("",), ("  ",), (None,), (" eur ",)], "x string")
    got = df.select(
        C.blank_default(F.col("x"), "d"), C.currency_default(F.col("x")), C.normalized_text(F.col("x"))
    )
    assert rows(got, sort=False) == [("d", "USD", ""), ("d", "USD", ""), ("d", "USD", ""), ("eur", "EUR", "eur")]


def test_pick_order_case_and_casts(make):
    df = make([("x", "7.5")], "Value string, price string")
    assert df.select(C.pick(df, ["price", "value"])).first()[0] == "x"
    assert df.select(C.pick(df, ["price", "value"], order="candidate")).first()[0] == "7.5"
    assert df.select(C.pick(df, ["value"], "double")).first()[0] is None
    absent = df.select(C.pick(df, ["close"], "decimal(18,6)").alias("c"))
    assert absent.first()[0] is None and absent.schema["c"].dataType.simpleString() == "decimal(18,6)"
    assert C.choose_column([" Close "], ["close"], "candidate") == " Close "
    assert C.choose_column([" Close "], ["close"]) is None
    with pytest.raises(ValueError):
        C.choose_column([], [], "other")


def test_aliases_by_table_and_by_constants(spark, make, rows):
    df = make([(" Paddy ",), ("CACAO",), ("rice",), ("Tea",), (None,)], "n string")
    expected = [(" Paddy ", "rice"), ("CACAO", "cocoa"), ("Tea", "tea"), ("rice", "rice"), (None, None)]
    for mapping in (read_mapping(spark), built_in_aliases()):
        assert rows(resolve_alias(df, "n", mapping), "n", "commodity") == sorted(expected, key=repr)


def test_alias_join_is_hash_join(spark, make):
    df = make([("rice",)], "n string")
    plan = resolve_alias(df, "n", read_mapping(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "HashJoin" in plan


def test_calendar_attributes(make):
    cases = ["2021-01-01", "2024-02-29", "2024-03-02", "2024-03-03", "2024-04-30", "2024-12-25"]
    df = make([(c,) for c in cases], "d date").select(*[c.alias(n) for n, c in K.calendar_columns(F.col("d")).items()])
    got = {r["date"].isoformat(): r for r in df.collect()}
    assert got["2021-01-01"]["week"] == 53 and got["2021-01-01"]["year"] == 2021
    assert got["2021-01-01"]["is_vietnam_public_holiday"]
    assert got["2024-02-29"]["date_id"] == 20240229 and got["2024-02-29"]["month_name"] == "February"
    assert (got["2024-03-02"]["day_of_week"], got["2024-03-02"]["is_weekend"]) == (6, True)
    assert (got["2024-03-03"]["day_of_week"], got["2024-03-03"]["is_weekend"]) == (0, True)
    assert got["2024-04-30"]["is_vietnam_public_holiday"] and not got["2024-12-25"]["is_vietnam_public_holiday"]


def test_harvest_labels_and_change(make):
    df = make([("coffee", 1), ("coffee", 2), ("coffee", 10), ("cocoa", 3), ("cocoa", 4), ("tea", 5)], "c string, m int")
    assert [r[0] for r in df.select(C.is_harvest_season(F.col("c"), F.col("m"))).collect()] == [
        True, False, True, True, False, False,
    ]
    assert [r[0] for r in df.select(label(F.col("c"), domain.DISPLAY_NAMES)).distinct().collect()].count("tea") == 1
    changes = make([(2.0, 1.0), (1.0, 0.0), (1.0, None)], "n double, o double")
    assert [r[0] for r in changes.select(percent_change(F.col("n"), F.col("o"))).collect()] == [100.0, None, None]
