import numpy as np
import pytest
from pyspark.sql import functions as F

from pricemill.operators.quantiles import exact_quantiles

SHARES = [0.0, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_are_exact(spark, accuracy):
    """With a coarse sketch most groups are larger than it is accurate, so the brackets decide."""
    rng = np.random.default_rng(3)
    groups = {
        "one": [4.0],
        "two": [1.0, 2.0],
        "many": rng.normal(size=3001).tolist(),
        "ties": rng.integers(0, 4, 2000).astype(float).tolist(),
        "skewed": (rng.pareto(0.7, 2500) * 1e3).tolist(),
        "equal": [7.5] * 900,
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("many", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r.quantiles for r in exact_quantiles(df, ["g"], "v", SHARES, accuracy).collect()}
    assert got.pop("none") is None
    plain = {r.g: r.q for r in df.filter("v is not null").groupBy("g").agg(F.percentile("v", F.array(*[F.lit(s) for s in SHARES])).alias("q")).collect()}
    assert got == plain
    for k, vs in groups.items():
        assert got[k] == pytest.approx(np.quantile(vs, SHARES).tolist(), rel=1e-12)


def test_only_values_in_between_meet(spark):
    """The window that ranks values reads a small part of a large group."""
    df = spark.range(200_000).select(F.lit("g").alias("g"), F.hash("id").cast("double").alias("v"))
    found = exact_quantiles(df, ["g"], "v", [0.5], accuracy=1000)
    assert found.first().quantiles == [df.agg(F.percentile("v", 0.5)).first()[0]]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in text and "functions=[partial_count(1)" in text
