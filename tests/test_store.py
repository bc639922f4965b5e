import os

import pytest
from pyspark.sql import functions as F

from pricemill import schemas
from pricemill.plans import loads
from pricemill.operators.upsert import keyed_upsert, replace_day_slice, with_missing_columns
from pricemill.session import run_folder
from pricemill.sources import readers, tables
from pricemill.operators.reshape import monthly_sheet_to_raw, resolve_headers

TABLE = "commodity string, price_date date, source string, price double"
KEYS = ["commodity", "price_date", "source"]


@pytest.fixture
def store(spark):
    return tables.TableStore(spark, run_folder(spark, "store"))


@pytest.fixture
def existing(make):
    return make(
        [("a", "2023-01-01", "s", 1.0), ("a", "2024-01-01", "s", 2.0), ("a", "2024-01-02", None, 3.0)], TABLE
    )


def test_keyed_upsert(make, rows, existing):
    incoming = make(
        [("a", "2024-01-01", "s", 9.0, "n"), ("b", "2024-01-01", "s", 4.0, "n"), ("a", "2024-01-02", None, 5.0, "n")],
        TABLE + ", extra string",
    )
    merged = keyed_upsert(existing, incoming, KEYS)
    assert rows(merged, "commodity", "price_date", "price", "extra") == [
        ("a", "2023-01-01", 1.0, None),
        ("a", "2024-01-01", 9.0, "n"),
        ("a", "2024-01-02", 3.0, None),
        ("a", "2024-01-02", 5.0, "n"),
        ("b", "2024-01-01", 4.0, "n"),
    ]


def test_day_slice_ignores_source(make, rows, existing):
    incoming = make([("a", "2024-01-01", "other", 7.0)], TABLE)
    assert (("a", "2024-01-01", "other", 7.0)) in rows(replace_day_slice(existing, incoming))
    assert replace_day_slice(existing, incoming).count() == 3


def test_missing_columns_ignore_case(existing):
    out = with_missing_columns(existing, {"PRICE": "double", "unit": "string"})
    assert out.columns == existing.columns + ["unit"]


def test_stored_upsert_touches_only_its_years_and_is_repeatable(spark, store, make, rows, existing):
    store.upsert("bronze.p", existing, KEYS)
    incoming = make([("a", "2024-01-01", "s", 9.0, "n")], TABLE + ", extra string")
    files = lambda: {f for f in store.read("bronze.p").inputFiles() if "price_year=2023" in f}
    before = files()
    for _ in range(2):
        assert store.upsert("bronze.p", incoming, KEYS)
        assert store.read("bronze.p").count() == 3
    assert files() == before
    assert ("2024-01-01", 9.0, "n") in rows(store.read("bronze.p"), "price_date", "price", "extra")
    assert not store.upsert("bronze.p", incoming.limit(0), KEYS)
    with pytest.raises(ValueError):
        store.upsert("bronze.p", incoming, ["commodity"])


def test_replace_may_read_what_it_replaces(store, existing):
    own = store.replace("gold.t", existing)
    want = own.filter("price > 1").count()
    assert store.replace("gold.t", own.filter("price > 1")).count() == want < 3


def test_failed_replace_leaves_the_table(store, existing):
    own = store.replace("gold.f", existing)
    with pytest.raises(Exception, match="broken"):
        store.replace("gold.f", own.withColumn("price", F.raise_error(F.lit("broken")).cast("double")))
    assert store.count("gold.f") == 3


def test_tables_with_a_common_name_start(store, existing):
    daily = store.replace("gold.fact_daily", existing)
    assert store.replace("gold.fact", daily).count() == 3


def test_only_an_absent_table_reads_as_empty(spark, store):
    schema = "price_date date, price double"
    assert store.read("bronze.none", schema).count() == 0
    spark.createDataFrame([(1,)], "a int").write.json(store.path("bronze.odd"))
    with pytest.raises(Exception):
        store.upsert("bronze.odd", spark.createDataFrame([("2024-01-01", 1.0)], "price_date string, price double").selectExpr("cast(price_date as date) price_date", "price"), ["price_date"])


def test_reload_and_append(store, existing):
    store.append("bronze.c", existing)
    assert store.count("bronze.c") == 3
    assert store.reload("gold.f", existing)
    assert not store.reload("gold.f", existing.limit(0))
    assert store.count("gold.f") == 3
    assert store.read("bronze.none", TABLE).count() == 0


def folders(store, layer):
    return sorted(os.listdir(f"{store.root}/{layer}"))


def test_refresh_writes_once_and_switches_at_the_end(spark, store, existing, monkeypatch):
    store.replace("gold.s", existing)
    assert len(folders(store, "gold")) == 1
    before = folders(store, "gold")

    # A job that dies after it has written, before the table is switched.
    with monkeypatch.context() as broken:
        broken.setattr(store, "_switch", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            store.replace("gold.s", existing.limit(1))
    assert store.count("gold.s") == 3 and spark.table(store.view("gold.s")).count() == 3

    # A wider schema shows with its rows.
    store.replace("gold.s", existing.limit(1).withColumn("more", F.lit(1)))
    assert store.read("gold.s").columns == [*existing.columns, "more"] == spark.table(store.view("gold.s")).columns
    store.replace("gold.s2", existing)
    assert len(folders(store, "gold")) == 4
    assert store.drop_old("gold.s") == 2 and not set(before) & set(folders(store, "gold"))
    assert store.count("gold.s") == 1 and store.count("gold.s2") == 3
    again = tables.TableStore(spark, store.root)
    assert again.count("gold.s") == 1


def test_upsert_after_a_refresh_stays_in_its_folder(store, make, existing):
    store.upsert("bronze.u", existing, KEYS)
    store.replace("bronze.u", store.read("bronze.u"), ["price_year"])
    at = store.path("bronze.u")
    store.upsert("bronze.u", make([("a", "2024-01-01", "s", 9.0)], TABLE), KEYS)
    assert store.path("bronze.u") == at and store.count("bronze.u") == 3
    assert store.read("bronze.u").filter("price = 9").count() == 1


def test_writing_job_counts(spark, store, existing):
    measures = {"rows": F.count(F.lit(1)), "no source": F.count_if(F.col("source").isNull())}
    table, seen = store.replace_measured("gold.m", existing, measures=measures)
    assert seen == {"rows": 3, "no source": 1} and table.count() == 3


FOUR = ["commodity", "price_date", "region", "source"]


def test_bucketed_upsert_leaves_stored_rows_in_place(spark, store, make, rows):
    schema = "commodity string, price_date date, region string, source string, price double"
    first = [("a", f"2024-01-{d:02d}", r, s, float(d)) for d in range(1, 29) for r in ("x", "y") for s in ("p", None)]
    store.upsert_bucketed("bronze.b", make(first, schema), FOUR, 8)
    load = make([("a", "2024-01-05", "x", "p", 50.0, "n"), ("a", "2024-01-05", "y", None, 60.0, "n"), ("b", "2024-01-05", "x", "p", 70.0, "n")], schema + ", extra string")

    merged = store.merged_buckets("bronze.b", load, FOUR, 8)
    text = merged._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    depth = lines[scan].index("FileScan")
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:  # an operator above the stored rows
            depth = at
            assert "Exchange" not in line, text

    for _ in range(2):  # the row without a source accumulates, as in any keyed merge
        store.upsert_bucketed("bronze.b", load, FOUR, 8)
    table = spark.table(store.view("bronze.b"))
    assert table.count() == len(first) + 3
    assert rows(table.filter("extra = 'n' AND source IS NOT NULL"), "commodity", "price") == [("a", 50.0), ("b", 70.0)]
    assert len([f for f in os.listdir(store.path("bronze.b")) if f.endswith(".parquet")]) <= 8
    assert rows(table.filter("source IS NOT NULL")) == rows(tables.keyed_upsert(make(first, schema), load, FOUR).filter("source IS NOT NULL"))


def test_declared_table_is_reloaded_unless_there_is_nothing(spark, store, make, rows):
    layer, folder = "reload_layer", run_folder(spark, "csv")
    full = make([("2024-01-31", "rice", 1.5, 1.0, 2.0)], schemas.FORECAST)
    store.export_csv(full, f"{folder}/full")
    store.export_csv(full.limit(0), f"{folder}/empty")
    assert loads.reload_forecast_csv(store, layer, f"{folder}/full")
    assert not loads.reload_forecast_csv(store, layer, f"{folder}/empty")
    assert loads.reload_forecast_csv(store, layer, f"{folder}/full")
    assert rows(spark.table(f"{layer}.forecast_lstm")) == rows(full)
    spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_names_and_bootstrap(spark):
    assert tables.qualified_name("t", " gold ") == "gold.t"
    assert tables.qualified_name("t") == "main.t"
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    assert warehouse
    tables.bootstrap(spark, ["scratch_layer"])
    tables.create_table(spark, "scratch_layer.forecast_lstm", schemas.FORECAST)
    tables.create_table(spark, "scratch_layer.forecast_lstm", schemas.FORECAST)
    assert spark.table("scratch_layer.forecast_lstm").count() == 0
    spark.sql("DROP DATABASE scratch_layer CASCADE")


def test_monthly_sheet(spark, rows):
    path = run_folder(spark, "sheet") + ".csv"
    lines = [
        "Prices",
        "monthly",
        "",
        "updated",
        ",Cocoa ,\"Coffee, Arabica\",Iron ore,\"Rice, Thai 5% \"",
        ",($/kg),($/kg),($/dmt),($/mt)",
        "1960M01,0.63,0.94,11.4,104.0",
        "1960M02,,0.95,11.4,NaN",
    ]
    with open(path, "w") as f:
        f.write("\n".join(lines))
    sheet = readers.read_monthly_sheet(spark, path)
    raw = monthly_sheet_to_raw(sheet, F.localtimestamp())
    assert raw.filter("price_date = 'nan'").count() == 3
    assert rows(raw.filter("price_date <> 'nan'"), "price_date", "price_usd", "commodity") == [
        ("1960M01", "0.63", "cocoa"),
        ("1960M01", "0.94", "coffee"),
        ("1960M01", "104.0", "rice"),
        ("1960M02", "0.95", "coffee"),
    ]


def test_monthly_sheet_skips_lines_by_place(spark, rows):
    path = run_folder(spark, "sheet") + ".csv"
    lines = ["A,B", "1960M01,1", "period,Cocoa", "1960M01,1", "A,B", "1960M02,2", "period,Cocoa"]
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    sheet = readers.read_monthly_sheet(spark, path, skip_rows=2)
    assert rows(sheet) == sorted([("1960M01", "1"), ("A", "B"), ("1960M02", "2"), ("period", "Cocoa")], key=repr)


@pytest.mark.parametrize("block", [7, 64, 10_000_000])
def test_sheet_with_line_breaks_in_cells(spark, rows, block):
    """Quotation marks decide where a record ends, wherever the file is cut into blocks."""
    path = run_folder(spark, "sheet") + ".csv"
    body = [f'19{60 + i}M01,"a ""b""\n{i},\n\nend",{i}.5' for i in range(30)]
    text = '"Title\nover two ""lines"""\nplain\nperiod,"No\nte","Cocoa "\n' + "\n".join(body) + '\n,"","($/kg)"\n'
    with open(path, "w") as f:
        f.write(text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        sheet = readers.read_monthly_sheet(spark, path, skip_rows=2)
        assert sheet.columns == ["period", "No te", "Cocoa"]
        want = [(f"19{60 + i}M01", f'a "b"\n{i},\n\nend', f"{i}.5") for i in range(30)] + [(None, None, "($/kg)")]
        got = [tuple(r) for r in sheet.collect()]
        assert sorted(((a, b or None, c) for a, b, c in got), key=repr) == sorted(want, key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_headers():
    found = resolve_headers(["Date", "COCOA beans", "Cotton, A Index"], {"Cocoa": "cocoa", "Cotton, A Index": "cotton", "Tea": "tea"})
    assert found == {"COCOA beans": "cocoa", "Cotton, A Index": "cotton"}


def test_csv_round_trip(spark, store, make, rows):
    path = run_folder(spark, "csv")
    df = make([("2024-01-31", "rice", 1.5, 1.0, 2.0)], schemas.FORECAST)
    store.export_csv(df, path)
    assert rows(readers.read_forecast_csv(spark, path)) == rows(df)


def test_mapping_from_csv_equals_built_in(spark, rows):
    path = run_folder(spark, "mapping")
    readers.read_mapping(spark).write.option("header", True).csv(path)
    assert rows(readers.read_mapping(spark, path)) == rows(readers.read_mapping(spark))
    assert readers.read_mapping(spark).count() == 21
