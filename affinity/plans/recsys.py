"""Recommendation study: filter -> time split -> models -> ranking metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators import metrics, recommend, splits
from affinity.operators.bounds import small_side
from affinity.session import ensure_checkpoint_dir, reliable_checkpoint, track_table
from affinity.sources import fixtures, io

# Fixed values of the study.
MIN_USER_RATINGS = 5
MIN_ITEM_RATINGS = 5
TRAIN_FRAC = 0.6
VAL_FRAC = 0.2
TOP_K = 100
EXPLICIT_RANKS = (20, 25, 30)
EXPLICIT_REGS = (0.04, 0.05, 0.06)
IMPLICIT_RANKS = (25, 26)
IMPLICIT_REGS = (0.125, 0.15)
IMPLICIT_ALPHAS = (1, 5, 10)
FIT_TOLERANCE = 1e-4  # of a user's right side; fits are at about 1e-7, another regularisation at 1e-2


def split_ratings(ratings: DataFrame) -> DataFrame:
    """F1 then F3 on (user_id, item_id, rating, ts): adds ``split``.

    The split is written once into the shared checkpoint folder, and every
    study reads train, val and test from it, as the split files are read in
    the file-based workflow; nothing stays cached.
    """
    filtered = splits.filter_sparse(ratings, min_user=MIN_USER_RATINGS, min_item=MIN_ITEM_RATINGS)
    return reliable_checkpoint(splits.time_split(filtered, train=TRAIN_FRAC, val=VAL_FRAC))


def fixture_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_ratings(fixtures.ratings(spark, sf_dir))


def popularity_quality(split_df: DataFrame, on: str = "test", k: int = TOP_K) -> DataFrame:
    """R1 + K1-K4: popularity list from train scored on ``on``."""
    train = split_df.filter(F.col("split") == "train")
    truth = split_df.filter(F.col("split") == on)
    top = recommend.popular_items(train, k)
    return metrics.ranking_metrics_shared(top, truth, k)


def als_quality(split_df: DataFrame, implicit: bool, rank: int, reg: float,
                alpha: float = 1.0, on: str = "test", k: int = TOP_K, seed: int = 42) -> DataFrame:
    """R4/R6 + R7 + R9 for one parameter point, with ``fit_optimal``: whether
    every user's factors solve their least-squares problem (``fit_residuals``)."""
    train = split_df.filter(F.col("split") == "train")
    if implicit:
        train = recommend.to_implicit(train)
    model = recommend.fit_als(train, rank=rank, reg=reg, implicit=implicit, alpha=alpha,
                              seed=seed)
    truth = split_df.filter(F.col("split") == on)
    recs = recommend.recommend_als(model, k, users=truth.select("user_id").distinct(), rows=False)
    off = recommend.fit_residuals(model, train, reg, implicit, alpha).agg(
        F.coalesce(F.max("residual") <= FIT_TOLERANCE, F.lit(True)).alias("fit_optimal"))
    return recommend.evaluate(recs, truth, k).crossJoin(F.broadcast(off))  # one row each


def tune_and_test(split_df: DataFrame, implicit: bool, k: int = TOP_K, seed: int = 42):
    """R8 then R9 on test: the grid of the study, best by validation NDCG."""
    train = split_df.filter(F.col("split") == "train")
    val = split_df.filter(F.col("split") == "val")
    test = split_df.filter(F.col("split") == "test")
    if implicit:
        train = recommend.to_implicit(train)
        best, results, model = recommend.tune(train, val, IMPLICIT_RANKS, IMPLICIT_REGS,
                                              IMPLICIT_ALPHAS, k=k, implicit=True, seed=seed)
    else:
        best, results, model = recommend.tune(train, val, EXPLICIT_RANKS, EXPLICIT_REGS,
                                              k=k, seed=seed)
    recs = recommend.recommend_als(model, k, users=test.select("user_id").distinct(), rows=False)
    test_metrics = recommend.evaluate(recs, test, k)
    return best, results, test_metrics


# ---------------------------------------------------------------- registered queries

def time_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F2 + F3: every filtered rating with its split."""
    return fixture_splits(spark, sf_dir).select("user_id", "item_id", "rating", "ts", "split")


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_sizes(fixture_splits(spark, sf_dir))


def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_overlap(fixture_splits(spark, sf_dir))


def split_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_ranges(fixture_splits(spark, sf_dir))


def split_order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_order_violations(fixture_splits(spark, sf_dir))


def popular_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = fixture_splits(spark, sf_dir).filter(F.col("split") == "train")
    return recommend.popular_items(train, TOP_K)


def popular_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: the popularity list for every test user."""
    s = fixture_splits(spark, sf_dir)
    top = recommend.popular_items(s.filter(F.col("split") == "train"), TOP_K)
    return recommend.recommend_popular(s.filter(F.col("split") == "test"), top)


def popularity_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fixture_splits(spark, sf_dir)
    top = recommend.popular_items(s.filter(F.col("split") == "train"), TOP_K)
    pu = metrics.ranking_metrics_shared(top, s.filter(F.col("split") == "test"), TOP_K,
                                        per_user=True)
    return pu.select("user_id", "n_rel", "n_hits",
                     *[F.round(c, 6).alias(c) for c in metrics.METRIC_COLS])


def implicit_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 on the train split."""
    return recommend.to_implicit(fixture_splits(spark, sf_dir).filter(F.col("split") == "train"))


def _in_range(table: DataFrame) -> DataFrame:
    """The table with its metrics replaced by whether all of them lie in [0, 1]:
    a fit depends on the machine in its last digits, this does not."""
    ok = F.lit(True)
    for c in metrics.METRIC_COLS:
        ok = ok & F.col(c).between(0.0, 1.0)
    return table.withColumn("metrics_in_range", ok).drop(*metrics.METRIC_COLS)


def als_explicit_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 + R7 + R9 at the explicit study's best point (rank 30, reg 0.05):
    users scored, whether the fit is optimal for all users, and whether the
    metrics are possible values."""
    return _in_range(als_quality(fixture_splits(spark, sf_dir), implicit=False, rank=30, reg=0.05))


def als_implicit_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 + R7 + R9 at the implicit study's best point (rank 25, reg 0.15, alpha 5)."""
    return _in_range(als_quality(fixture_splits(spark, sf_dir), implicit=True, rank=25, reg=0.15, alpha=5.0))


def als_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-100 lists of the explicit model for all train users, one row
    per list: its length, first and last rank, distinct items, how many items
    come from the training data, and whether the scores fall."""
    s = fixture_splits(spark, sf_dir)
    train = s.filter(F.col("split") == "train")
    model = recommend.fit_als(train, rank=30, reg=0.05)
    recs = recommend.recommend_als(model, TOP_K, rows=False)
    known = small_side(train.select("item_id").distinct().withColumn("known", F.lit(1)))
    n, head = F.size("items"), F.col("_pos") == 0  # what the list itself tells goes with its first item
    falls = F.forall(F.zip_with(F.slice("scores", 1, n - 1), F.slice("scores", 2, n - 1), lambda a, b: a >= b), lambda x: x)
    rows = recs.filter(n > 0).select("user_id", F.size(F.array_distinct("items")).alias("_distinct"), falls.alias("_falls"),
                                     F.posexplode("items").alias("_pos", "item_id")).select(
        "user_id", "item_id", (F.col("_pos") + 1).alias("rank"), F.when(head, F.col("_distinct")).alias("_distinct"),
        F.when(head, F.col("_falls")).alias("_falls"))
    return rows.join(known, "item_id", "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
        F.max("_distinct").cast("bigint").alias("n_distinct"), F.count("known").alias("n_from_train"), F.max("_falls").alias("ordered"))


def als_explicit_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8 + R9: the explicit grid on val, best model on test: parameters, users,
    metrics in range, and whether the chosen point has the best validation NDCG."""
    return _tuning_table(*tune_and_test(fixture_splits(spark, sf_dir), implicit=False))


def als_implicit_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tuning_table(*tune_and_test(fixture_splits(spark, sf_dir), implicit=True))


def _tuning_table(best: dict, results: DataFrame, test: DataFrame) -> DataFrame:
    """A row per grid point on val, and one for the test split; the test row has
    no parameters, as the best point may differ by machine, but says whether
    it was a best one of the grid."""
    val_rows = _in_range(results).select(F.lit("val").alias("split"), "rank", "reg", "alpha", "n_users", "metrics_in_range",
                                         F.lit(None).cast("boolean").alias("best_of_grid"))
    top = results.agg(F.max("ndcg_at_k").alias("top"))
    test_row = _in_range(test).crossJoin(F.broadcast(top)).select(  # one row each
        F.lit("test"), F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(None).cast("double"), "n_users",
        "metrics_in_range", F.col("top") == F.lit(best["ndcg"]))
    return val_rows.union(test_row)


def popularity_sample_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: predicted and actual lists of the first five test users."""
    s = fixture_splits(spark, sf_dir)
    test = s.filter(F.col("split") == "test")
    top = recommend.popular_items(s.filter(F.col("split") == "train"), TOP_K)
    return metrics.sample_lists(recommend.recommend_popular(test, top), test, 5)


def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the split written once as Parquet partitioned by split (under the
    checkpoint folder, a fresh subfolder per call) and read back, all rows."""
    import uuid

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/splits-{uuid.uuid4().hex}"
    splits.write_splits(fixture_splits(spark, sf_dir), path)
    return track_table(io.read_parquet(spark, path, ["user_id", "item_id", "rating", "ts", "split"]), path)


def _with_faults(s: DataFrame) -> DataFrame:
    """The split with faults put in: a third of the users have their train and
    test rows swapped, and a fifth of the items' train rows appear in test too."""
    swapped = s.withColumn("split", F.when(F.col("user_id") % 3 == 0, F.when(F.col("split") == "train", "test").when(
        F.col("split") == "test", "train").otherwise(F.col("split"))).otherwise(F.col("split")))
    return swapped.union(s.filter("split = 'train' AND item_id % 5 = 0").withColumn("split", F.lit("test")).select(*s.columns))


def split_overlap_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 on a split that leaks."""
    return splits.split_overlap(_with_faults(fixture_splits(spark, sf_dir)))


def split_order_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 on a split that breaks the order of time."""
    return splits.split_order_violations(_with_faults(fixture_splits(spark, sf_dir)))
