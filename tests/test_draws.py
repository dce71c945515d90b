import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import draws, pairs, skew


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 65_536, 65_537])
def test_permutation(n):
    out = draws.permute(np.arange(n), n)
    assert sorted(out.tolist()) == list(range(n))


def test_large_numbers_stay_in_range_and_differ():
    n = 3_000_000_000 * 2_999_999_999 // 2
    out = draws.permute(np.arange(200_000), n)
    assert out.min() >= 0 and out.max() < n and len(set(out.tolist())) == 200_000
    assert abs(out.mean() / (n / 2) - 1) < 0.01 and abs((out % 2).mean() - 0.5) < 0.01


@pytest.mark.parametrize("users", [0, 1, 2, 3, 4, 7, 30])
def test_every_pair_has_one_number(spark, users):
    got = [(min(r.i, r.j), max(r.i, r.j)) for r in draws.pair_numbers(spark, users, 10**6).collect()]
    assert sorted(got) == [(i, j) for i in range(users) for j in range(i + 1, users)]


def test_pairs_look_drawn_at_random(spark):
    rows = draws.pair_numbers(spark, 500, 30_000).collect()
    gaps = np.bincount([abs(r.i - r.j) for r in rows], minlength=500)[1:]
    want = np.arange(499, 0, -1) / (500 * 499 / 2) * len(rows)
    chi = ((gaps - want) ** 2 / want).sum()
    assert chi < 498 + 5 * (2 * 498) ** 0.5
    seen = np.bincount([r.i for r in rows] + [r.j for r in rows], minlength=500)
    assert 0.6 < seen.min() / 120 and seen.max() / 120 < 1.5


def test_dense_numbers_follow_the_order(spark):
    df = spark.createDataFrame([(f"u{(i * 37) % 500:04d}", i) for i in range(500)], "u string, x int").repartition(7)
    got = sorted((r.number, r.u) for r in skew.dense_numbers(df, "u").collect())
    assert got == [(i, f"u{i:04d}") for i in range(500)]
    assert skew.dense_numbers(df.limit(0), "u").count() == 0


def test_many_draws_without_a_window(spark):
    r = spark.range(30_000).select((F.col("id") * 3).alias("user_id"))
    df = pairs.random_pairs(r, 10_000)
    plan = df._jdf.queryExecution().toString()
    assert "Window" not in plan and "TakeOrdered" not in plan
    rows = [tuple(x) for x in df.collect()]
    assert len(set(rows)) == 10_000 and all(a < b and a % 3 == b % 3 == 0 for a, b in rows)
