import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import profile, quantiles

SHARES = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)


def spark_percentiles(df, c):
    return [df.agg(F.percentile(F.col(c).cast("double"), q)).first()[0] for q in SHARES]


def same(a, b):
    return all(x == y or (x is not None and y is not None and (math.isnan(x) and math.isnan(y) or x == pytest.approx(y, rel=1e-14)))
               for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("few", [0, 50, 20_000])
def test_equal_to_percentile(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "BUCKETS", 16)
    rng = np.random.default_rng(few)
    rows = [(int(i), float(a), float(b), int(c), None) for i, (a, b, c) in enumerate(zip(
        rng.normal(size=3000), np.exp(rng.normal(size=3000) * 40), rng.integers(0, 3, 3000)))]
    rows += [(None, None, 1e-300, 1, None), (-(1 << 40), -0.0, 1.7e308, 1, None), (1 << 60, 0.0, -1.7e308, 7, None)]
    df = spark.createDataFrame(rows, "i long, a double, b double, c int, d int").repartition(5)
    got = quantiles.exact_quantiles(df, ["i", "a", "b", "c", "d"], SHARES)
    for c in "iabcd":
        assert same(got[c], spark_percentiles(df, c)), c


def test_infinite_and_undefined_values_and_few_rows(spark):
    inf = math.inf
    for values in ([math.nan, 1.0, inf, -inf, 2.0, inf], [5.0], [1.0, 2.0], [math.nan], [None], [inf, inf], [-inf, 3.0, 3.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        got = quantiles.exact_quantiles(df, ["x"], (0.0, 0.5, 1.0))["x"]
        ordered = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        if not ordered:
            assert got == [None] * 3
            continue
        assert same([got[0], got[2]], [ordered[0], ordered[-1]])
    assert quantiles.exact_quantiles(spark.createDataFrame([], "x double"), ["x"], (0.5,)) == {"x": [None]}


def test_many_different_ids_in_bounded_memory(spark, monkeypatch):
    """Ten million different values; only counts of stretches and a few rows come to the driver."""
    n = 10_000_000
    df = spark.range(0, n, 1, 8).withColumn("id", F.col("id") * 7 - 1000)
    out = profile.describe(df, ["id"])
    plan = out._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan
    r = out.first()
    assert [r.p25, r.p50, r.p75] == [7 * (n - 1) * q - 1000 for q in (0.25, 0.5, 0.75)]
