"""Reusable column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from affinity.functions.hashing import PRIME


def hash_mod(x: Column | str, a: int, b: int, p: int = PRIME) -> Column:
    """(a*x + b) mod p in bigint, never negative. An x so large that a*x + b
    leaves 63 bits is an error under ANSI arithmetic, not a wrapped value."""
    x = F.col(x) if isinstance(x, str) else x
    return F.pmod(F.lit(a).cast("bigint") * x.cast("bigint") + F.lit(b).cast("bigint"), F.lit(p))


def guarded_pearson(x: str, y: str) -> Column:
    """Pearson correlation that is NULL (never an error) for a constant side.

    covar_pop / (stddev_pop * stddev_pop); one row or zero variance gives NULL.
    """
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def round_doubles(df, digits: int = 6, cols=None):
    """Round the double columns (or ``cols``) of a small report to ``digits``,
    so two engines whose float sums differ in the last bits agree."""
    from pyspark.sql.types import DoubleType
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in names else F.col(c)
                       for c in df.columns])
