"""Sparse filtering, per-user time split and split checks (F1-F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.skew import number_within
from affinity.sources.io import write_parquet

SPLITS = ("train", "val", "test")


def filter_sparse(df: DataFrame, user: str = "user_id", item: str = "item_id",
                  min_user: int = 5, min_item: int = 5) -> DataFrame:
    """drop items with fewer than ``min_item`` rows, then users with fewer
    than ``min_user`` of the remaining rows. One pass, no fixpoint: an item can
    end below ``min_item`` after the user step.

    Counts are partial aggregates (only (key, count) is shuffled); the
    semi-joins become broadcasts when AQE measures a small side, and AQE splits
    a skewed key on the big side otherwise.
    """
    items = df.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_item)
    kept = df.join(items.select(item), item, "left_semi")
    users = kept.groupBy(user).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_user)
    return kept.join(users.select(user), user, "left_semi")


def time_split(df: DataFrame, user: str = "user_id", time: str = "ts", item: str = "item_id",
               train: float = 0.6, val: float = 0.2, split_col: str = "split") -> DataFrame:
    """number each user's rows by (time, item); position
    ``(row - 1) / total``; train ``<= train``, val ``<= train + val``, else
    test. Adds ``split_col``; all input columns are kept.

    The item tie-break makes equal times split the same way on every run.
    """
    numbered = number_within(df, user, [time, item], row_col="_row", size_col="_total")
    pos = (F.col("_row") - 1) / F.col("_total")
    upper = train + val
    split = (F.when(pos <= train, F.lit("train"))
             .when(pos <= upper, F.lit("val"))
             .otherwise(F.lit("test")))
    return numbered.withColumn(split_col, split).drop("_row", "_total")


def split_frames(split_df: DataFrame, split_col: str = "split") -> dict[str, DataFrame]:
    """The three splits as separate frames (without the split column)."""
    return {s: split_df.filter(F.col(split_col) == s).drop(split_col) for s in SPLITS}


def write_splits(split_df: DataFrame, path: str, split_col: str = "split") -> None:
    """one pass, one folder per split (``split=train`` ...) within a new
    version of the table, published when all of it is written."""
    write_parquet(split_df, path, partition_by=[split_col])


def split_sizes(split_df: DataFrame, split_col: str = "split") -> DataFrame:
    """rows per split."""
    return split_df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def split_overlap(split_df: DataFrame, user: str = "user_id", item: str = "item_id",
                  split_col: str = "split") -> DataFrame:
    """distinct (user, item) pairs shared by each pair of splits.

    One aggregate over (user, item) instead of three intersects: the set of
    splits each pair occurs in, then a count for each pair of splits.
    """
    per_pair = split_df.groupBy(user, item).agg(
        *[F.max((F.col(split_col) == s).cast("int")).alias(f"_in_{s}") for s in SPLITS])
    exprs = []
    for i, a in enumerate(SPLITS):
        for b in SPLITS[i + 1:]:
            exprs.append(F.sum(F.col(f"_in_{a}") * F.col(f"_in_{b}")).alias(f"{a}_{b}"))
    out = per_pair.agg(*exprs)
    return out.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in out.columns])


def split_ranges(split_df: DataFrame, time: str = "ts", split_col: str = "split") -> DataFrame:
    """first and last time of each split, one job."""
    return split_df.groupBy(split_col).agg(F.min(time).alias("min_ts"), F.max(time).alias("max_ts"))


def split_order_violations(split_df: DataFrame, user: str = "user_id", time: str = "ts",
                           split_col: str = "split") -> DataFrame:
    """F8: users whose last train time is after their first val time, or whose
    last val time (or last train time) is after their first test time. Empty
    for a correct time split."""
    s = F.col(split_col)
    t = F.col(time)
    per_user = split_df.groupBy(user).agg(
        F.max(F.when(s == "train", t)).alias("train_max"),
        F.min(F.when(s == "val", t)).alias("val_min"),
        F.max(F.when(s == "val", t)).alias("val_max"),
        F.min(F.when(s == "test", t)).alias("test_min"))
    bad = ((F.col("train_max") > F.col("val_min")) | (F.col("val_max") > F.col("test_min"))
           | (F.col("train_max") > F.col("test_min")))
    return per_user.filter(bad)


def _side(df: DataFrame, user: str, item: str, side: str) -> DataFrame:
    """(measure, n): rows, distinct users and distinct items, by two aggregates
    by key; no row is expanded for a distinct count."""
    users = df.groupBy(user).agg(F.count(F.lit(1)).alias("c")).agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("rows"), F.count_if(F.col(user).isNotNull()).alias("users"))
    items = df.groupBy(item).agg(F.count(F.lit(1)).alias("c")).agg(F.count_if(F.col(item).isNotNull()).alias("n"))
    return users.select(F.explode(F.array(
        F.struct(F.lit(f"rows_{side}").alias("measure"), F.col("rows").alias("n")),
        F.struct(F.lit(f"users_{side}").alias("measure"), F.col("users").alias("n")))).alias("m")).select("m.*").union(
        items.select(F.lit(f"items_{side}"), "n"))


def filter_report(before: DataFrame, after: DataFrame, user: str = "user_id",
                  item: str = "item_id") -> DataFrame:
    """Rows, users and items before and after a filter, and what was dropped."""
    both = _side(before, user, item, "before").union(_side(after, user, item, "after"))
    names = [f"{m}_{s}" for s in ("before", "after") for m in ("rows", "users", "items")]
    out = both.agg(*[F.max(F.when(F.col("measure") == m, F.col("n"))).alias(m) for m in names])
    return out.select("*", *[(F.col(f"{m}_before") - F.col(f"{m}_after")).alias(f"{m}_dropped") for m in ("rows", "users", "items")])
