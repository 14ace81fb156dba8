import math
import random

import pytest
from pyspark.sql import functions as F

from ratecraft.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("bins", [1024, 3])
def test_equal_to_percentile_on_distinct_doubles(spark, bins):
    rng = random.Random(1)
    values = [rng.gauss(0, 10 ** rng.randrange(-3, 6)) for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(7)
    want = df.select(F.percentile("x", PROBS)).first()[0]
    assert exact_quantiles(df, "x", PROBS, bins=bins) == pytest.approx(want, rel=1e-15)


def test_ties_one_value_and_no_value(spark):
    df = spark.createDataFrame([(v / 2,) for v in range(1, 11) for _ in range(v * 3)], "x double")
    assert exact_quantiles(df, "x", PROBS) == df.select(F.percentile("x", PROBS)).first()[0]
    assert exact_quantiles(df.where("x = 2"), "x", [0.0, 0.5]) == [2.0, 2.0]
    assert exact_quantiles(df.where("false"), "x", [0.5]) == [None]


def test_extremes(spark):
    inf, nan = float("inf"), float("nan")
    values = [-inf, -1.7e308, -1.0, 5e-324, 0.0, 1.7e308, inf, inf, nan]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, "x", [i / 8 for i in range(9)])
    assert got[:8] == values[:3] + [0.0, 5e-324] + values[5:8] and math.isnan(got[8])


def test_rounds_bring_back_bounded_rows(spark, monkeypatch):
    from ratecraft.operators import quantiles
    seen = []
    real = quantiles._bins
    monkeypatch.setattr(quantiles, "_bins", lambda x, i, b: seen.append(real(x, i, b)) or seen[-1])
    df = spark.range(100_000).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    assert exact_quantiles(df, "x", [0.5], bins=64) == [(49999.0 ** 2 + 50000.0 ** 2) / 2]
    assert max(len(b) for found in seen for b in found.values()) <= 66
