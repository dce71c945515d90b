"""Exact quantiles in bounded memory, by distributed selection.

The rows at the wanted ranks are closed in from both sides: a pass counts the
values of a range in ``BUCKETS`` equal stretches, with the smallest and largest
value of each, and the stretch that holds the rank becomes the next range,
between those two values. A range of one value is the answer; once a range
holds at most ``FEW`` rows, they are read in order. All ranks of all columns
share a pass, and a pass brings at most ranks x ``BUCKETS`` rows to the
driver, however many rows and different values there are. Ranges shrink
``BUCKETS``-fold each time, so evenly spread values take two or three passes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.session import reliable_checkpoint

BUCKETS = 1024
FEW = 20_000
INF = float("inf")


class _Rank:
    """One rank (0-based, among the finite values of a column) and the range that holds it."""

    def __init__(self, col: str, rank: int, low: float, high: float, n: int):
        self.col, self.rank, self.low, self.high, self.n = col, rank, low, high, n

    @property
    def value(self) -> float | None:
        return self.low if self.low == self.high else None

    def inside(self) -> Column:
        return F.col(self.col).between(self.low, self.high)

    def bucket(self) -> Column:
        """0 to BUCKETS - 1; halves, as the range may be wider than a double."""
        share = (F.col(self.col) / 2 - self.low / 2) / (self.high / 2 - self.low / 2)
        return F.least(F.floor(share * BUCKETS).cast("int"), F.lit(BUCKETS - 1))

    def narrow(self, counted: list) -> None:
        """``counted``: (bucket, rows, smallest, largest), ascending."""
        for _, n, low, high in counted:
            if self.rank < n:
                self.low, self.high, self.n = low, high, n
                return
            self.rank -= n


def _close_in(rows: DataFrame, ranks: list[_Rank]) -> None:
    while wide := [r for r in ranks if r.value is None and r.n > FEW]:
        ranges = {(r.col, r.low, r.high): r for r in wide}  # ranks in one range are counted once
        hits = F.array(*[F.when(r.inside(), F.struct(F.lit(i).alias("i"), r.bucket().alias("b"), F.col(r.col).alias("x")))
                         for i, r in enumerate(ranges.values())])
        counts = (rows.select(F.explode(F.array_compact(hits)).alias("h")).groupBy("h.i", "h.b")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("h.x").alias("low"), F.max("h.x").alias("high")).collect())
        for i, key in enumerate(ranges):
            found = sorted((c.b, c.n, c.low, c.high) for c in counts if c.i == i)
            for r in [r for r in wide if (r.col, r.low, r.high) == key]:
                r.narrow(found)
    for key in {(r.col, r.low, r.high) for r in ranks if r.value is None}:  # at most FEW rows each
        some = [r for r in ranks if (r.col, r.low, r.high) == key]
        values = sorted(v for (v,) in rows.select(key[0]).filter(some[0].inside()).collect())
        for r in some:
            r.low = r.high = values[r.rank]


def exact_quantiles(df: DataFrame, cols: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """For each column its quantiles at ``shares`` (0 to 1), interpolated
    linearly between the two nearest ranks, as ``percentile`` does; null where a
    column has no value. NaN counts as larger than every number.

    The columns are written once, as doubles, and each pass reads them.
    """
    rows = reliable_checkpoint(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))

    def measures(c: str) -> list[Column]:
        x = F.col(c)
        finite = ~F.isnan(x) & (F.abs(x) < INF)
        return [F.count_if(finite), F.min(F.when(finite, x)), F.max(F.when(finite, x)),
                F.count_if(x == -INF), F.count_if(x == INF), F.count_if(F.isnan(x))]

    flat = rows.agg(*[m.alias(f"{i}_{k}") for i, c in enumerate(cols) for k, m in enumerate(measures(c))]).first()
    ranks: dict[tuple[str, int], _Rank] = {}
    plans = {}
    for i, c in enumerate(cols):
        n, low, high, below, above, nan = (flat[f"{i}_{k}"] for k in range(6))
        total = n + below + above + nan

        def at(rank: int, c=c, n=n, low=low, high=high, below=below, above=above):
            if rank < below:
                return -INF
            if rank < below + n:
                return ranks.setdefault((c, rank - below), _Rank(c, rank - below, low, high, n))
            return INF if rank < below + n + above else math.nan

        plans[c] = [(q * (total - 1), at(math.floor(q * (total - 1))), at(math.ceil(q * (total - 1)))) if total else None for q in shares]
    _close_in(rows, list(ranks.values()))

    def value(x) -> float:
        return x.value if isinstance(x, _Rank) else x

    def between(place: float, a: float, b: float) -> float:
        part = place - math.floor(place)
        return a if a == b or not part else a * (1 - part) + b * part

    return {c: [None if p is None else between(p[0], value(p[1]), value(p[2])) for p in found] for c, found in plans.items()}
