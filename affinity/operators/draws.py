"""Random draws of distinct pairs by number, without putting anything in order.

Among U users numbered from 0, every pair has a number below N = U (U - 1) / 2:
number q is the pair of a = q mod U and the user q div U + 1 places further
on a circle. A keyed permutation of 0 .. N - 1 (a Feistel network with cycle
walking) maps 0 .. n - 1 to n different numbers, hence to n different pairs. So
each draw comes from its own index alone: n of them take n rows, whatever U is
(up to 3 * 10^9, where pair numbers reach 2^62), and no two are equal.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.session import ship_code

# Fixed values of the permutation: a prime below 2^31, and for each round a
# multiplier and two summands (leading digits of pi, e and the golden ratio).
PRIME = 2147483647
KEYS = ((314159265, 358979323, 846264338), (271828182, 845904523, 536028747), (161803398, 874989484, 820458683),
        (141421356, 237309504, 880168872), (173205080, 756887729, 352744634), (223606797, 749978969, 640917366))


def half_size(n: int) -> int:
    """The smallest power of two whose square is at least n: the network works on pairs of numbers below it."""
    half = 1
    while half * half < n:
        half *= 2
    return half


def scramble(x: np.ndarray, half: int) -> np.ndarray:
    """A permutation of 0 .. half^2 - 1."""
    left, right = x // half, x % half
    for a, b, c in KEYS:
        t = (right * a + b) % PRIME
        t = (t * t + c) % PRIME
        t = (t * t + a) % PRIME
        left, right = right, (left + t) % half
    return left * half + right


def permute(x: np.ndarray, n: int) -> np.ndarray:
    """A permutation of 0 .. n - 1: what leaves the range is scrambled on until it is back."""
    half = half_size(n)
    out = scramble(x.astype(np.int64), half)
    while len(outside := np.flatnonzero(out >= n)):
        out[outside] = scramble(out[outside], half)
    return out


def pair_numbers(spark, users: int, n: int) -> DataFrame:
    """(draw, i, j): min(n, all) different pairs of 0 .. users - 1, by their draw."""
    ship_code(spark)
    possible = users * (users - 1) // 2

    @F.pandas_udf("long")
    def drawn(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), possible))

    size = max(users, 1)
    i = F.expr(f"q % {size}L")
    j = F.expr(f"(q % {size}L + q div {size}L + 1) % {size}L")  # whole numbers throughout
    numbers = spark.range(min(n, possible)).withColumnRenamed("id", "draw").withColumn("q", drawn("draw"))
    return numbers.select("draw", i.alias("i"), j.alias("j"))
