"""Registered queries against an independent engine, and the shape of their plans."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import compare  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from pricemill.catalog import QUERIES  # noqa: E402
from pricemill.oracle import ORACLES  # noqa: E402
from pricemill.sources import driver_tables as D  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables are absent")


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, con, name):
    verdict = compare.compare(spark, con, name, SF)
    assert verdict.startswith("ok"), verdict


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: Their plans solve one small system per commodity in Python.
SOLVERS = {"window_models", "mllib_forecast", "mllib_holdout_error"}


#: Their plans only read tables that they have written.
READERS = {n for n in QUERIES if n.startswith(("stream_state_", "incremental_", "warehouse_"))} | {"published_forecast", "bucketed_upsert"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - READERS))
def test_no_pairwise_joins_or_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text
    assert text.count("MapInPandas") == (name in SOLVERS)
    if name in SOLVERS:
        above = text[: text.index("MapInPandas")].count("\n")
        below = text.splitlines()[above + 1 : above + 4]
        assert any("ObjectHashAggregate" in x for x in below), below


def test_no_exchange_of_all_prices_by_market(spark):
    """The market dimension is stored before the fact joins it, so its measured size lets it be broadcast, and its
    plan does not read the prices again."""
    text = plan(QUERIES["star_fact"](spark, SF))
    joins = [x for x in text.splitlines() if "Join [country" in x]
    assert joins and all("BroadcastHashJoin" in x for x in joins)
    assert text.count("/monthly-") <= 2 and text.count("/daily-") <= 2


def test_scan_reads_only_needed_columns(spark):
    text = plan(D.raw_monthly(spark, SF).select("period"))
    assert "l_tax" not in text and "l_comment" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:" in text


def test_windows_of_the_fact_share_one_exchange(spark):
    text = plan(QUERIES["rolling_price_metrics"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 2


def test_raw_rows_are_reduced_before_the_shuffle(spark):
    text = plan(QUERIES["latest_load_per_day"](spark, SF))
    assert text.index("functions=[max(") < text.index("Exchange hashpartitioning") < text.index("functions=[partial_max(")


def test_validity_is_not_copied_into_a_second_filter(spark):
    text = plan(D.monthly(spark, SF))
    assert text.count("RLIKE") == 1


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["dq_accepted"](spark, SF))
    assert "PushedFilters: [" in text and "Not(In(o_orderpriority" in text
