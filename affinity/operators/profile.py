"""Data profiling (P1-P9): counts, nulls, distributions, summaries, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.operators.quantiles import exact_quantiles
from affinity.operators.splits import filter_report  # noqa: F401  (P9 lives with F1)

QUANTILES = (0.25, 0.5, 0.75)


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """P1."""
    return df.agg(F.count(F.lit(1)).alias(name))


def table_profile(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """P1 + P2 in one job: rows and distinct values of each column; ``approx``
    takes the HyperLogLog++ estimate, which needs no shuffle of the values."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[distinct(c).alias(f"n_{c}") for c in cols])


def null_counts(df: DataFrame) -> DataFrame:
    """One row, the number of nulls in each column under its name; 0 for
    an empty input."""
    return df.agg(*[F.count_if(F.isnull(c)).alias(c) for c in df.columns])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)


def exploded_counts(df: DataFrame, col: str, pattern: str, name: str = "value") -> DataFrame:
    """P5: split a multi-valued string on a regex, count each value, most
    frequent first (value breaks ties). Null strings contribute nothing."""
    vals = df.select(F.explode(F.split(F.col(col), pattern)).alias(name))
    return (vals.groupBy(name).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(name)))


def describe(df: DataFrame, cols: Sequence[str], exact: bool | None = None) -> DataFrame:
    """Typed summary, one row per column: count, mean, sample stddev,
    min, 25/50/75 % and max (as doubles). One pass over ``df``.

    Quartiles are exact (linear interpolation) or within 1/10000 of the rank
    (``percentile_approx``). Exact ones are found before this returns, by
    ``quantiles.exact_quantiles``, whose memory does not grow with the values;
    by default integer columns, such as sizes and ids, get them. Pass ``exact``
    to decide for all.
    """
    kinds = dict(df.dtypes)
    fine = [c for c in cols if (exact if exact is not None else kinds[c] in ("tinyint", "smallint", "int", "bigint"))]
    found = exact_quantiles(df, fine, QUANTILES) if fine else {}

    def measures(c: str) -> list[Column]:
        x = F.col(c).cast("double")
        middle = [F.lit(q) for q in found[c]] if c in found else [F.percentile_approx(x, q, 10000) for q in QUANTILES]
        return [F.avg(x), F.stddev_samp(x), F.min(x), *middle, F.max(x)]

    names = ("mean", "stddev", "min", "p25", "p50", "p75", "max")
    wide = df.agg(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), *[
        m.cast("double").alias(n) for m, n in zip(measures(c), names)]).alias(f"_{i}") for i, c in enumerate(cols)])
    return wide.select(F.explode(F.array(*[f"_{i}" for i in range(len(cols))])).alias("s")).select("s.*")


def column_types(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, whether nulls are allowed,
    and the number of values that are present, counted in one pass."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.lit(f.nullable).alias("nullable"), F.col(f.name).alias("n_present")) for i, f in enumerate(df.schema.fields)])).alias("c")).select("c.*")


def sample_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order (a bounded top-n, no full sort)."""
    return df.orderBy(*order).limit(n)

